"""Operators: DataFrames in, lazy DataFrame out."""
