"""Streaming of the summary checks."""
