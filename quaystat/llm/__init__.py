"""Training-data operators: scoring, near-duplicates, decontamination, tokens, packing."""
