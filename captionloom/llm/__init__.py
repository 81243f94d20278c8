"""Operators for large text corpora: deduplication, scoring, packing, codecs and filters."""
