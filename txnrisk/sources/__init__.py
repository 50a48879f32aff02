"""Schemas, scans, sinks and the adapter views over the test tables."""
