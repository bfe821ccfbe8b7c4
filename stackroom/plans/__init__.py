"""Rule sets, the whole flow and the queries over the test tables."""
