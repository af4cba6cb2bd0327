"""Streaming: resumable, exactly-once table copy with Structured Streaming."""
