"""Operators of a training-data pipeline: cleaning, deduplication, mixing, packing and output."""
