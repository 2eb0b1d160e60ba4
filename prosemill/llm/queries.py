"""All queries of this subpackage and their SQL."""

from . import (  # noqa: F401  (they register)
    byte_bpe, decontaminate, exact_dedup, html_main_text, importance_resampling, language_spans,
    license_scan, line_dedup, ngram_join, quality_ranking, substring_dedup, url_rules, vector_codes,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
