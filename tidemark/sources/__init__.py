"""Readers for documents and queries, and the embedding tables."""
