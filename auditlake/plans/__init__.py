"""Queries: the operators bound to the benchmark tables, and the SQL they are checked with."""
