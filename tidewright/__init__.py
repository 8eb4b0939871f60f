"""Reusable Spark operators for message ingest, batch views, keyed serving and scoring."""
