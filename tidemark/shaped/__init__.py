"""Export-shaped rows derived from the test tables, the registered queries over them,
and the equivalent SQL."""
