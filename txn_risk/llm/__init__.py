"""Operators of a large-scale training-data pipeline over raw text, pages and embeddings."""
