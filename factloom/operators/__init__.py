"""Operators of the summary checks."""
