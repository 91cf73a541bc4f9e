"""Training-data operators: language, search, privacy, near copies, tokens, decontamination, quality, shards."""
