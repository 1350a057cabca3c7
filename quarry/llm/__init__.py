"""Training-data operators: near-duplicates, search, language, PII, secrets, tokens, packing."""
