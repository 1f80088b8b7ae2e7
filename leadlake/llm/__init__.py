"""Training-data operators: deduplication, language ID, quality, licences, search, sharding, mixing, packing."""
