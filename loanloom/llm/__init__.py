"""Operators for preparing training text: search, packing, mixing, deduplication, language, privacy, toxicity and secrets."""
