"""Operators for preparing training data: counting, scoring, filtering, deduplication and mixing."""
