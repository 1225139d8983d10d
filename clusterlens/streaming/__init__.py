"""Structured Streaming: streaming k-means, stream scoring, report snapshots."""
