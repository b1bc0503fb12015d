"""Training-data operators: filtering, deduplication, extraction, formatting and packing."""
