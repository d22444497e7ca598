"""Training-data operators: deduplication, scanning, mixing, packing, search and scoring at corpus scale."""
