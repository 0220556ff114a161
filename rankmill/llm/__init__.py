"""Operators of a training-data pipeline: cleaning, scanning, deduplication, mixing, archives."""
