"""Operators for preparing training text: dedup, near-dedup, tokens, licences, toxicity, personal data,
mixing, sharding and packing. Nothing else in the library imports this subpackage."""
