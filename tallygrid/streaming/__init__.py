"""Structured Streaming: the batch operators over micro-batches."""
