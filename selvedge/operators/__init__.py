"""Operators: functions from DataFrames to a DataFrame, without reading or writing."""
