"""Operators of a training-data pipeline; nothing else in the library imports this subpackage.

One module per operator; ``queries`` holds the thin registered queries and their SQL.
"""
