"""Readers: driver test tables, landed CSV/JSON files (batch and stream)."""
