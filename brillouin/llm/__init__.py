"""Operators for large text corpora (training-data preparation) on Spark DataFrames.

Nothing outside this subpackage imports it; `queries` registers its operators.
"""
