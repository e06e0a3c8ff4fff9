"""Scans of the driver tables, the derived inputs, and profile helpers."""
