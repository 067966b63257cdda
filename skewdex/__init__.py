"""Skew-aware text indexing and search over grouped document collections, on Spark."""
