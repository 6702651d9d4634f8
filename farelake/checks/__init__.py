"""farelake.checks."""
