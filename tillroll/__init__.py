"""Retail order analytics on Spark: ingest, enrichment, views and reports."""
