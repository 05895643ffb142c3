"""Operators of a training-data pipeline (tokens, scoring, dedup, filtering).

Nothing else in the library imports this subpackage.
"""
