"""Scans and sinks: landing files, catalog tables, layers, rejects, published versions, run log."""
