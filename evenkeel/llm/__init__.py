"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it; ``queries.py`` holds the thin
``opN_`` queries that the repository's entry file registers.
"""
