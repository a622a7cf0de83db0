"""Structured Streaming: incremental landing (availableNow) and per-micro-batch DQ."""
