"""farelake.streaming."""
