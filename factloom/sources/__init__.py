"""Sources of the summary checks."""
