"""Operators for large training-data pipelines: scoring, filtering, deduplication, sharding,
archives, packing and tokenizing.  Nothing else in the library imports this subpackage."""
