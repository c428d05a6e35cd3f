"""Operators for training-data corpora: packing, deduplication, quality, language, WARC."""
