"""Operators for training-data pipelines: dedup, filtering, decontamination, tokenization, archives."""
