"""Operators of a training-data pipeline: search, tokens, chat, packing, duplicates, leaks, toxicity, personal data."""
