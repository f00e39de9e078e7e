"""Operators of a training-data pipeline: search, packing, fingerprints, language models, token files, joins, filters."""
