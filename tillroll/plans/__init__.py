"""Composite queries over an orders table."""
