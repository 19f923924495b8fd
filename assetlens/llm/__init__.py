"""Text operators for training-data pipelines: fingerprints, packing, license scans, quality, near-duplicates,
language, line removal, tokenizing and chat formatting. ``queries`` registers one query for each."""

from .oracle import ORACLE_SQL
from .queries import QUERIES

__all__ = ["QUERIES", "ORACLE_SQL"]
