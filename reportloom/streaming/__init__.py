"""Incremental jobs on Structured Streaming; each run takes what is new and stops."""
