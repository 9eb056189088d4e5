"""Named queries over the test tables, their SQL oracle and plan checks."""
