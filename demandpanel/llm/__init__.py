"""Training-data operators: sharding, filtering, deduplication, decontamination and packing of text tables."""
