"""Relational building blocks: blocking, retrieval, features, metrics, splits, lists."""
