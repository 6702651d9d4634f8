"""farelake.functions."""
