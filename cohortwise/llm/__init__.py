"""Operators of a training-data pipeline over the corpus tables.

Nothing else in the library imports this package. Every operator is a
function of DataFrames; ``registry`` holds the queries and their SQL.
"""
