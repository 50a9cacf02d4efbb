"""Named queries over the test tables, each beside the SQL it has to equal."""
