"""Training-data operators: deduplication, decontamination, packing, filtering and extraction."""
