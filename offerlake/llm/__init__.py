"""Training-data operators: dedup, filtering, mixing, encoding and search at corpus scale."""
