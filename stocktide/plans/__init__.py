"""Named queries over the test tables, each with its checking SQL where SQL can express it."""
