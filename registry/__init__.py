"""Named queries over the given tables, and the same results in plain SQL."""
