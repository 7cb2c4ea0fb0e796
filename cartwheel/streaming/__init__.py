"""Structured Streaming flows: file ingest, quarantine fan-out, label join, spine."""
