"""Readers: directory discovery, header/annotation text, pages, raw binaries."""
