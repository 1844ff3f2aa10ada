"""Every query of the library by name, with its SQL where SQL can express it."""

from __future__ import annotations

from larkspan.plans import file_queries, oracles, queries

QUERIES = queries.QUERIES | file_queries.QUERIES
ORACLES = oracles.ORACLES | file_queries.ORACLES
FLAGSHIP = "w5_merge_segments"

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
