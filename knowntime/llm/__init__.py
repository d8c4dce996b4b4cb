"""Operators for building language-model training data at corpus scale.

Nothing outside this subpackage imports it. Every module offers a general
operator; ``queries.py`` holds the thin registered queries and their SQL.
"""
