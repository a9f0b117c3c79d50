"""Operators for preparing training data: filtering, deduplication, scoring, tokenising, packing."""
