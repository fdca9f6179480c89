"""File-arrival streams (Structured Streaming)."""
