"""Operators for preparing training text at scale: sharding, fingerprints, deduplication,
filters, mixing, packing and licence recognition over a ``documents`` table."""
