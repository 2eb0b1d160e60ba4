"""All registered queries and their SQL."""

from . import (  # noqa: F401  (they register)
    corpus_queries, language_queries, report_queries, row_queries, sketch_queries, toxicity_queries,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
