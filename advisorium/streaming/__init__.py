"""The ingest as streams: same results as the batch jobs over the same rows."""
