"""Training-data operators: sharding, extraction, de-duplication, tokens, classifiers, search, packing."""
