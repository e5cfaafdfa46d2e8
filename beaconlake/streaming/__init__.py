"""Structured Streaming jobs over the same operators the batch jobs use."""
