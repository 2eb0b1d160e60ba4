"""Quality scores learned from preference pairs (Bradley-Terry).

A document's utility is a weighted sum of measures of its whole text. Of a pair of a good and
a bad document the good one wins with the logistic function of the difference of utilities;
the weights minimise that loss. The threshold, which becomes score 0.7, lies between the distinct
utilities that have the share of bad labels below them, over all labelled rows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.storage import stage
from .registry import query, table
from .shingles import _blocks, word_hashes

#: labelled rows of each label that the fit uses at most, and pairs
FIT_ROWS, FIT_PAIRS = 10_000, 200_000
THRESHOLD = 0.7

_CLASSES = np.zeros(256, np.int64)
for _k, _of in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\n\r\x0b\x0c", b".,;:'\"-()",
                          b"!?", b"|", b"#$%&*@^~+=<>[]{}\\/_`"), 1):
    _CLASSES[list(_of)] = _k
_CLASSES[128:] = 9
MEASURES = ("log_words", "word_bytes", "distinct", "repeats", "upper", "digits", "marks", "calls", "bars", "symbols",
            "wide", "lines", "line_repeats")


def _measures(texts: pa.Array) -> Iterator[tuple[float, ...]]:
    for _, offsets, raw in _blocks(texts, 1 << 20):
        words, counts = word_hashes(offsets, raw)
        n = len(counts)
        doc = np.repeat(np.arange(n), np.diff(offsets))
        kinds = np.bincount(doc * 10 + _CLASSES[raw], minlength=10 * n).reshape(n, 10)
        size, ends = kinds.sum(1), np.cumsum(counts)
        letters = np.maximum(1, kinds[:, 1] + kinds[:, 2])
        ink = np.maximum(1, size - kinds[:, 4])
        for i in range(n):
            own = words[ends[i] - counts[i]:ends[i]]
            w = len(own)
            lines = raw[offsets[i]:offsets[i + 1]].tobytes().split(b"\n")
            yield (np.log1p(w), ink[i] / max(1, w), len(np.unique(own)) / max(1, w) ** 0.8,
                   float((own[1:] == own[:-1]).mean()) if w > 1 else 0.0,
                   kinds[i, 1] / letters[i], *(kinds[i, k] / ink[i] for k in (3, 5, 6, 7, 8)),
                   kinds[i, 9] / ink[i], len(lines) / max(1, w), 1 - len(set(lines)) / len(lines))


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def measure(texts: pa.Array) -> pa.Array:
    """The measures of a text, in the order of MEASURES."""
    return pa.array([np.asarray(m, float).tolist() for m in _measures(texts)], pa.list_(pa.float64()))


def fit(good: np.ndarray, bad: np.ndarray, pairs: int = FIT_PAIRS, steps: int = 30, ridge: float = 1e-3):
    """(centre, scale, weights, utilities of all) from measures of good and of bad documents."""
    both = np.concatenate([good, bad])
    centre, scale = both.mean(0), both.std(0) + 1e-9
    rng = np.random.default_rng(7)
    i, j = rng.integers(0, len(good), pairs), rng.integers(0, len(bad), pairs)
    x = ((good - centre) / scale)[i] - ((bad - centre) / scale)[j]
    w = np.zeros(x.shape[1])
    for _ in range(steps):  # Newton steps on the logistic loss of the differences
        p = 1 / (1 + np.exp(np.clip(x @ w, -30, 30)))
        gradient = ridge * w - (x * p[:, None]).mean(0)
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(x) + ridge * np.eye(len(w))
        w -= np.linalg.solve(curve, gradient)
    u = ((both - centre) / scale) @ w
    return centre, scale, w, u


def _held_out(key):
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def _learned(measured: DataFrame, labels: DataFrame, id_col: str, label_col: str, fit_rows: int):
    """The score as an expression over measures ``x``, learned from rows (id, x) with labels."""
    labels = labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("label"))
    known = measured.where(~_held_out(F.col("id"))).join(labels, "id").where("id IS NOT NULL AND label IN (0, 1)").select(
        "label", "x", F.xxhash64("id").alias("h"), "id")
    sample = {k: np.array([r.x for r in known.where(F.col("label") == k).orderBy("h", "id", "x").select("x").limit(fit_rows).collect()])
              for k in (0, 1)}
    if not len(sample[0]) or not len(sample[1]):
        return F.lit(THRESHOLD)
    centre, scale, w, u = fit(sample[1], sample[0])
    utility = F.aggregate(F.zip_with("x", F.array(*(F.lit(float(v)) for v in w / scale)), lambda a, b: a * b),
                          F.lit(float(-centre @ (w / scale))), lambda s, v: s + v)
    told = stage(known.select("label", utility.alias("u")), "utilities")
    threshold = cut_at(told, "u", told.where("label = 0").count())
    spread = max(1e-9, float(np.std(u)) / 4)
    total = (utility - F.lit(threshold)) / F.lit(spread) + F.lit(float(np.log(THRESHOLD / (1 - THRESHOLD))))
    return 1 / (1 + F.exp(-F.least(F.greatest(total, F.lit(-700.0)), F.lit(700.0))))


def cut_at(values: DataFrame, column: str, below: int, pieces: int = 4096, rounds: int = 5) -> float:
    """A number between two distinct values of a column, with ``below`` values under it, or as
    near to that as ties allow; the largest value if all are equal.

    The interval that holds the value of that rank is cut into pieces whose values are counted,
    round by round, so the driver sees at most ``pieces`` counts at a time. Values that the last
    round does not tell apart (2**-60 of their range) are ties.
    """
    v = F.col(column)
    low, high = values.agg(F.min(v), F.max(v)).first()
    bottom, top, before = low, high, 0
    for _ in range(rounds):
        step = (top - bottom) / pieces
        if step <= 0 or bottom + step == bottom:
            break
        piece = F.least(F.floor((v - F.lit(bottom)) / F.lit(step)), F.lit(pieces - 1))
        inside = values.where((v >= F.lit(bottom)) & (v <= F.lit(top)))
        counts = sorted(map(tuple, inside.groupBy(piece.alias("piece")).agg(F.count("*"), F.min(v), F.max(v)).collect()))
        for _, n, least, most in counts:
            if before + n >= max(1, below):
                bottom, top = least, most
                break
            before += n
    facts = values.agg(F.max(F.when(v < F.lit(bottom), v)), F.min(F.when(v > F.lit(top), v)),
                       F.count_if(v < F.lit(bottom)), F.count_if(v <= F.lit(top))).first()
    under, over, fewer, more = facts
    sides = [((top + over) / 2, abs(more - below))] if over is not None else []
    sides += [((bottom + under) / 2, abs(fewer - below))] if under is not None else []
    return float(min(sides, key=lambda side: side[1])[0]) if sides else float(high)


def _measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return stage(docs.select(F.col(id_col).cast("bigint").alias("id"), measure(text).alias("x")), "measures")


def rank_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "quality", fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per input row: id, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from 0.7 on).

    The score depends on the whole text alone. Weights are learned from labelled rows whose
    ``crc32(id as text) % 4`` is not 2, at most ``fit_rows`` of each label, those with the
    smallest hash of their id; the driver sees the measures of these rows only. Every row is
    scored. The threshold is taken over all such rows; equal utilities stay on one side of it. A null text counts as empty, and an empty text gets the score of its measures, all
    zero. Null ids are scored, never learned from, and not held out. Repeated rows are scored
    as rows. Labels other than 0 and 1 say nothing. Without labels of both kinds nothing can
    be learned, and all rows score 0.7. Extra columns are ignored.
    """
    measured = _measured(docs, id_col, text_col)
    score = _learned(measured, labels, id_col, label_col, fit_rows)
    return measured.select(F.col("id").alias(id_col), _held_out(F.col("id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "quality", fit_rows: int = FIT_ROWS) -> DataFrame:
    """The input rows whose score is 0.7 or more, unchanged; see ``rank_quality``. Texts are
    measured again where they lie, rather than joined with their scores."""
    score = _learned(_measured(docs, id_col, text_col), labels, id_col, label_col, fit_rows)
    rows = docs.select(F.struct("*").alias("row"), measure(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("x"))
    return rows.where(score >= THRESHOLD).select("row.*")


@query("op6_quality_ranking")
def op6_quality_ranking(spark, sf_dir):
    return rank_quality(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))
