"""Training-data operators: packing, tokenizers, deduplication, search, quality."""
