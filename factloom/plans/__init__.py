"""Named queries over the driver tables, with the SQL that gives the same rows."""
