"""Named end-to-end queries (the SURVEY section 7.4 list) and their SQL oracles."""

from .queries import QUERIES, Inputs
from .oracle import ORACLE_SQL

__all__ = ["QUERIES", "ORACLE_SQL", "Inputs"]
