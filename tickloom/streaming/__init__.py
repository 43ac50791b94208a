"""Structured Streaming jobs: the bounded transforms on streaming frames,
the stateful batcher, the current-price snapshot and the two-sink tee."""
