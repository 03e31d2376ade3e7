"""Operators of a training-data pipeline: tokens, duplicates, quality, languages, pages, shards."""
