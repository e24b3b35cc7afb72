"""Training-data operators: extraction, classification, near-duplicates, indexing, packing and storage."""
