"""Operators for training-data pipelines: fingerprints, dedup, decontamination, scoring, formatting, mixing."""
