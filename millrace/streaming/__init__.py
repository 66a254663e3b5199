"""Incremental ingestion: the batch loads, run once per micro-batch of new files."""
