"""Structured Streaming versions of scoring, alerting and trends."""
