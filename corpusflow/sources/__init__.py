"""Readers: config, state, catalogue pages, file listings, binary files, OCR outputs."""
