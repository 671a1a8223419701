"""The scoring and checking loop on Structured Streaming."""
