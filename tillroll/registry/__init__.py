"""Queries over the driver tables, each with a SQL oracle where SQL can express it."""
