"""Registered queries: the operators run on the given tables, with their SQL twins."""
