"""Named queries over the given tables, each with an independent SQL statement where SQL can express it."""
