"""Scalar and conditional column functions, and the rule catalogue."""
