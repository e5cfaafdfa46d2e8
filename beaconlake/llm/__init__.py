"""Operators of a training-data pipeline: deduplication, language and quality filters, tokenisation, packing, search."""
