"""The registered queries over the given tables, and the same questions in SQL."""
