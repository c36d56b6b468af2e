"""Layered tabular analytics on Spark DataFrames.

Yearly extracts are read, aligned to one typed schema, stored as bronze,
silver and gold layers, checked, and summarised. Every operator takes a
DataFrame and returns a DataFrame, built from Spark's own functions.
"""
