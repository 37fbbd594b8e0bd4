"""Lodging analytics on Spark DataFrames.

Operators take DataFrames and plain parameters and return DataFrames; column names are
arguments, so the same operators run on any table with the right kinds of columns.
"""
