"""Queries over the given tables, each with SQL that recomputes it from them."""
