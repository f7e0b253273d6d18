"""Training-data operators: packing, deduplication, fingerprints, tokenizing, language and
license detection, nearest neighbours. Nothing else in the library imports this package."""
