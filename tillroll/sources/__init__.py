"""Readers and writers: CSV inbox, orders table, file split."""
