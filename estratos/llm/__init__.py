"""Operators for training corpora: scoring, deduplication, decontamination, mixing and sharding of documents."""
