"""Operators for preparing training data: one module per operator, one function
from DataFrames to DataFrames each. Nothing else in the package imports this folder."""
