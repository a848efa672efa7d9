"""Reads: tables, staged slices, configuration and catalog extracts."""
