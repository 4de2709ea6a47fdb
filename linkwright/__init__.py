"""Multilingual record linkage and text-corpus preparation on PySpark."""

__version__ = "0.1.0"
