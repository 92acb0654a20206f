"""Conversions over streams of source rows."""
