"""Sinks: landing zone, tick lake, Kafka, current-price snapshot, CSV, tee."""
