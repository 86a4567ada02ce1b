"""Selvedge: catalogue analytics and data preparation as plain Spark DataFrame operators."""
