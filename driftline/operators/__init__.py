"""Analytic operators: DataFrames in, lazy DataFrames out."""
