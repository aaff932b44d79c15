"""Structured Streaming forms of the ingest jobs and of the weekly totals."""
