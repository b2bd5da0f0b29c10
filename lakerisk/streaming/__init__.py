"""Structured Streaming ingestion and refresh."""
