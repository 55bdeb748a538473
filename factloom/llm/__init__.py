"""Operators for preparing training data at scale: tokenising, deduplicating, filtering and mixing documents."""
