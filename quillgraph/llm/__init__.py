"""Operators for building training data: filters, dedup, tokens, search and mixing.

Nothing outside this subpackage imports it.
"""
