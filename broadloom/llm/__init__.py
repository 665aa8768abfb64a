"""Operators of a training-data pipeline: deduplication, classifiers, packing, index and shard writers."""
