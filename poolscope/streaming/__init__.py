"""Structured Streaming forms of the document and log pipelines."""
