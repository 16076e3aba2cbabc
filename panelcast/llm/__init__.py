"""Operators of a training-data pipeline: deduplication, quality, language,
mixing, packing, token and web-archive files. Nothing else in the library
imports this subpackage."""
