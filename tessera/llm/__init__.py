"""Operators of a training-data pipeline (fingerprints, dedup, classifiers, mixing, packing)."""
