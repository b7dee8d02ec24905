"""Training-data operators: dedup, license scans, mixing, packing, fingerprints, models, token counts, archives."""
