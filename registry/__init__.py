"""The registered queries: inputs shaped from the given tables, and their SQL twins."""
