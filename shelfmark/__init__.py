"""Catalog quality, recommendation and ranking analytics written as Spark DataFrame work.

Every operator takes DataFrames and returns a DataFrame; the few that must look at the
data before they can plan (a median, a vocabulary, a block layout) say so in their docstring.
"""
