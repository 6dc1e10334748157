"""Operators for training-data corpora: documents, pages and embeddings."""
