"""Language identification: sampling, the built-in stop-word scorer, the model hook."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .scoring import batch_scorer, scorer_registry
from .text import bound, share

LABEL_PREFIX = "__label__"
UNKNOWN = (LABEL_PREFIX + "unknown", 0.0)


def sample(text: Column, size: int | None = 1000, strategy: str = "quarter") -> Column:
    """The characters a language model sees; with ``size`` None all of them.

    ``quarter``: ``size`` characters from the 25 % mark, or the last ``size`` if that
    runs over the end. ``head``: the first ``size`` characters, newlines as spaces.
    """
    if strategy == "head":
        return F.translate(text if size is None else F.substring(text, 1, size), "\n", " ")
    if strategy != "quarter":
        raise ValueError(f"unknown sampling strategy {strategy!r}; use quarter or head")
    if size is None:
        return text
    n = F.length(text)
    start = F.least(F.floor(n / 4).cast("int"), n - F.lit(size)) + F.lit(1)
    return F.when(n > size, F.substring(text, start, F.lit(size))).otherwise(text)


def model_text(text: Column) -> Column:
    """One line, single spaces, stripped; only for the model."""
    return F.regexp_replace(
        F.regexp_replace(text, r"(?U)\s+", " "), "^ | $", "")


def strip_label(label: Column) -> Column:
    return F.regexp_replace(label, f"^{LABEL_PREFIX}", "")


def stopword_scorer(text: Column) -> Column:
    """Label with the most stop-word hits and its share of all hits.

    One pass over the text finds the stop words of all languages; a word counts for
    every language that lists it. Ties go to the language listed first; no hit at all
    is unknown with score 0.
    """
    every = sorted({w for words in P.STOPWORDS.values() for w in words})
    found = F.regexp_extract_all(F.lower(text), F.lit(P.java(P.whole_words(every))), F.lit(0))

    def per_language(found):
        return F.struct(*[
            F.size(F.filter(found, lambda word: word.isin(*words))).cast("bigint").alias(lang)
            for lang, words in P.STOPWORDS.items()])

    return bound(found, lambda f: bound(per_language(f), _best_label))


def _best_label(hits: Column) -> Column:
    langs = list(P.STOPWORDS)
    best = F.greatest(*[hits[lang] for lang in langs])
    label = F.lit(UNKNOWN[0])
    for lang in reversed(langs):
        label = F.when(hits[lang] == best, F.lit(LABEL_PREFIX + lang)).otherwise(label)
    total = sum((hits[lang] for lang in langs[1:]), hits[langs[0]])
    return F.struct(
        F.when(best == 0, F.lit(UNKNOWN[0])).otherwise(label).alias("label"),
        F.coalesce(share(best, total), F.lit(UNKNOWN[1])).alias("score"),
    )


def model_scorer(load, predict):
    """Scorer around an external model; a failing batch is labelled unknown."""
    return batch_scorer(load, predict, "label string, score double", on_error=UNKNOWN)


#: name -> (model text -> struct<label, score>); add a model with ``register``
SCORERS = scorer_registry(stopword=stopword_scorer)


def predict(text: Column, scorer: str = "stopword", size: int | None = None, strategy: str = "quarter") -> Column:
    """struct<label, score> for each text, from the whole of it unless ``size`` says less."""
    return SCORERS[scorer](model_text(sample(text, size, strategy)))
