"""Training-data operators: detection, deduplication, scoring, tokenising and packing of text documents."""
