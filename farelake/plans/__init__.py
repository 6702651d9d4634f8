"""farelake.plans."""
