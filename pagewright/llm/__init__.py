"""Operators for building language-model training data.

Nothing outside this subpackage imports it.  One module per operator; ``queries``
registers the thin production queries and their SQL.
"""
