"""Incremental jobs on Structured Streaming's file checkpoint."""
