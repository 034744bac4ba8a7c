"""Operators for preparing training data: deduplication, scans, scoring, mixing and packing of documents."""
