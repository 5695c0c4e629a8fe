"""Operators on canonical events: every function takes DataFrames and returns a DataFrame, and runs no action."""
