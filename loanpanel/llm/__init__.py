"""Operators of a training-data pipeline: packing, redaction, filters, search, near copies, mixing, shards, scores."""
