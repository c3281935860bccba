"""Operators for training data: near duplicates, packing, fingerprints, secrets, token counts, mixing, quality, toxicity."""
