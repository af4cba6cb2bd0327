"""Training-data operators over documents, pages and embeddings (see README, section llm)."""
