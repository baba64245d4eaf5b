"""The micro-batch ingest job."""
