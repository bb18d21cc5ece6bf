"""Operators for training-data pipelines: text quality, near-duplicates,
contamination, personal data, packing, tokens, links and licences.

Nothing outside this package imports it; ``queries`` registers its queries."""
