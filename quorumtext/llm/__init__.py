"""Training-data operators: mixing, counting, packing, dedup, filtering and extraction."""
