"""Feeds and sinks: Kafka, files with the same columns, and derived fixtures."""
