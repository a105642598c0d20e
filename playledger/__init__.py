"""Listening-history analytics on Spark: ingest, typed topics, a star schema, weekly recaps."""
