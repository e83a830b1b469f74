"""All registered queries."""

from tabulon.plans import (cluster_queries, decompose_queries, frame_queries, language_queries,  # noqa: F401
                           lazy_queries, source_queries, text_queries)
from tabulon.plans.cluster_queries import flagship
from tabulon.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]
