"""The analytics queries, each a function of a transactions DataFrame."""
