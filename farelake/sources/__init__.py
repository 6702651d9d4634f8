"""farelake.sources."""
