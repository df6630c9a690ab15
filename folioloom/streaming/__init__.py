"""Incremental ingestion of new book files."""
