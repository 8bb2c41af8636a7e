"""Runnable queries over the benchmark tables and the SQL that checks them.

Importing the modules registers everything; ``registry`` holds the two dictionaries.
"""

from tidemark.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
