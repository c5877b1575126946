"""Query catalog over the test tables."""
