"""Structured Streaming: message sources, parsing, micro-batches, metrics."""
