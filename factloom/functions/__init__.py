"""Functions of the summary checks."""
