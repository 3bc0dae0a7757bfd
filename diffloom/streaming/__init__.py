"""Incremental and streaming jobs (L1-L4)."""
