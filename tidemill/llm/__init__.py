"""Operators that a training-data pipeline needs, written as Spark jobs.

Nothing else in the library imports this subpackage.
"""
