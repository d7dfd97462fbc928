"""Streaming: incremental landing of payload files with Structured Streaming."""
