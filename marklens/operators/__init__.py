"""Operators: DataFrames in, DataFrames out; the caller runs the action."""
