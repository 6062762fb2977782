"""Readers. All of them return lazily scanned, splittable DataFrames."""
