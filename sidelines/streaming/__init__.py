"""The incremental jobs as Structured Streaming queries."""
