"""The CSV ingest as a Structured Streaming job."""
