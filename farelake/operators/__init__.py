"""farelake.operators."""
