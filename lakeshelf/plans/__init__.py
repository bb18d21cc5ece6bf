"""Compositions of operators: role mapping of the test tables, the silver
cleaning chain, the gold incremental load, and the query registry."""
