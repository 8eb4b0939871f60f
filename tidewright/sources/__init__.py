"""Readers: topics, tables and fetched pages."""
