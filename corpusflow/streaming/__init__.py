"""Incremental ingest (R1) and last-write-wins folds (R2)."""
