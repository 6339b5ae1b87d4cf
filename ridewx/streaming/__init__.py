"""Structured Streaming forms of the enrichment and the hourly metrics."""
