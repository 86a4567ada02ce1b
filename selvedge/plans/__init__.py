"""Registered queries over the named tables, each with its SQL where SQL can express it."""
