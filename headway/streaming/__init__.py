"""Structured Streaming: the continuous form of the batch operators."""
