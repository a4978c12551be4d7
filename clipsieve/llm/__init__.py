"""Operators for training-data pipelines over a ``documents`` table, one module each.

Every operator takes and returns DataFrames, reads only the columns it names (so further columns of any
name do no harm) and states in its docstring what it returns for nulls, empty texts, ties and empty tables.
``queries`` holds the registered queries and their SQL.
"""
