"""Lexicon-based toxicity and the hook for external classifiers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .scoring import scorer_registry
from .text import share, word_count

DEFAULT_MAX_RATIO = 0.001


def hits(text: Column, words=P.TOXIC_WORDS) -> Column:
    """Case-insensitive whole-word matches of the lexicon; 0 for an empty lexicon."""
    if not words:
        return F.lit(0).cast("bigint")
    return F.regexp_count(text, F.lit(P.java(P.whole_words(words), "iuU"))).cast("bigint")


def ratio(text: Column, words=P.TOXIC_WORDS) -> Column:
    """Hits per whitespace word; null for a text without words."""
    return share(hits(text, words), word_count(text))


def is_toxic(text: Column, words=P.TOXIC_WORDS, max_ratio: float = DEFAULT_MAX_RATIO) -> Column:
    """Hit ratio above the threshold; with a threshold of 0 any hit counts."""
    if not words:
        return F.lit(False)
    found = text.rlike(P.java(P.whole_words(words), "iuU"))
    if max_ratio <= 0:
        return found
    return found & F.coalesce(ratio(text, words) > max_ratio, F.lit(True))


def lexicon_scorer(lexicons: dict | None = None):
    """Text -> struct with one score in [0, 1] per category.

    A score of 0.5 is a hit ratio equal to the filter's default threshold, so
    ``score > 0.5`` and the filter agree. Categories without a lexicon score 0.
    """
    lexicons = lexicons if lexicons is not None else {"toxicity": P.TOXIC_WORDS}

    def score(text: Column) -> Column:
        def one(category):
            density = F.coalesce(ratio(text, lexicons.get(category, ())), F.lit(0.0))
            return F.least(F.lit(1.0), density * F.lit(0.5 / DEFAULT_MAX_RATIO)).alias(category)

        return F.struct(*[one(c) for c in P.TOXICITY_CATEGORIES])

    return score


#: name -> (text -> struct of the six categories); add a classifier with ``register``
SCORERS = scorer_registry(lexicon=lexicon_scorer())
