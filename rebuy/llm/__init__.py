"""Operators for preparing training text at scale.

One module per operator; ``queries`` holds the thin registered queries and
``sql`` their DuckDB counterparts.  Nothing outside this package imports it.
"""
