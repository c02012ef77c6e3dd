"""Operators for large text corpora.

Nothing outside this subpackage imports it, so the catalogue engine works without it.
"""
