"""Operators: functions from DataFrames to a DataFrame, none of which needs a global session."""
