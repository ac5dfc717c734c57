"""Operators of a training-data pipeline: quality, language, tokens, near copies, packing, mixing, files."""
