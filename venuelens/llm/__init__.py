"""Operators of a training-data pipeline over document and page tables.

Nothing else in the library imports this subpackage. Every operator reads whole texts, partitions
by Spark and returns DataFrames; the registered queries are in ``queries.py``.
"""
