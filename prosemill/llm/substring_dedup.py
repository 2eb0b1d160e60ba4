"""Dedup of repeated passages by hashing units of text.

The units of a text are its lines, or the sentences of its lines. Every normalised unit has a
digest; fragments of the digests' range see which digests occur again anywhere, so that only
repeated units are shuffled with their places. Of each the earliest ranked place keeps the unit
and the others go: lines of any length, sentences where repeats that follow each other make up
enough words, so that a lone common sentence stays. Offsets refer to the original text.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import hot_keys, join_by_key, join_salted
from ..sources.storage import stage
from .registry import query, table

_GATHER = 1_000_000
#: words that a run of repeated sentences needs to be removed; a repeated line needs one
LEAST_WORDS = 20
#: characters of text for each fragment of the digests' range, at most: a few million units
_FRAGMENT_CHARS = 200_000_000
_ENDS = {"line": r"\n|\Z", "sentence": r"[.!?]+(?=\s)|\n|\Z"}


def units(text: str, unit: str = "sentence") -> Iterator[tuple[int, int, str]]:
    """(start, end, normalised words) of the units of a text, blank ones left out. A line ends
    before a newline, a sentence also after its last mark of .!? before white space."""
    start = 0
    for match in re.finditer(_ENDS[unit], text):
        end = match.start() if match[0] == "\n" else match.end()
        words = text[start:end].lower().split()
        if words:
            begin = start
            while text[begin].isspace():
                begin += 1
            yield begin, end, " ".join(words)
        start = match.end()


def _digest(words: str) -> bytes:
    return hashlib.blake2b(words.encode(), digest_size=16).digest()


def _prints(fragments: int, unit: str):
    """Texts -> per fragment the sorted 64-bit prints of their units, and how often a task has each."""
    def send(prints):
        values, times = np.unique(np.array(prints, np.uint64), return_counts=True)
        part = (values >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)
        for f in np.unique(part).tolist():
            yield f, values[part == f].tobytes(), times[part == f].astype(np.uint32).tobytes()

    def batch(prints):
        part, *blobs = zip(*send(prints), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *(pa.array(b, pa.binary()) for b in blobs)], names=["part", "prints", "times"])

    def run(batches):
        prints = []
        for b in batches:
            for text in b.column(0):
                prints += [int.from_bytes(_digest(w)[:8], "big") for _, _, w in units(text.as_py(), unit)]
                if len(prints) >= _GATHER:
                    yield batch(prints)
                    prints = []
        if prints:
            yield batch(prints)

    return run


def _again(t: pa.Table) -> pa.Table:
    """The prints of a fragment that occur again, with the number of their places."""
    values, where = np.unique(np.frombuffer(b"".join(t["prints"].to_pylist()), np.uint64), return_inverse=True)
    times = np.bincount(where, np.frombuffer(b"".join(t["times"].to_pylist()), np.uint32), len(values)).astype(np.int64)
    return pa.table({"print": pa.array(values[times > 1].view(np.int64)), "n": pa.array(times[times > 1])})


def _places(unit: str):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            out = []
            for key, h, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                key, h = key.as_py(), h.as_py()
                for no, (start, end, words) in enumerate(units(text.as_py(), unit)):
                    digest = _digest(words)
                    out.append((key, h, no, start, end, words.count(" ") + 1, int.from_bytes(digest[:8], "big", signed=True), digest))
                if len(out) > 50_000:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)

    return run


_PLACE = "id bigint, h bigint, no int, start int, end int, words int, print bigint, digest binary"


def _batch(rows):
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)],
                                      names=["id", "h", "no", "start", "end", "words", "print", "digest"])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line",
                      least_words: int | None = None, fragments: int | None = None) -> DataFrame:
    """Passages that go: ``id``, ``h`` (hash of the row's text), ``start`` and ``end`` (code
    points of the original text), ``words``, ``units``, and ``keep_id`` and ``keep_start`` of
    the earliest place of its first unit.

    ``unit`` is ``line`` or ``sentence``; units are compared in lower case with single spaces. The
    rank of a place is (id, text, position), null ids last. A place is a repeat if its unit has an
    earlier one; a run of repeats goes if it has ``least_words`` words or more: by default one
    for lines, so that every repeat goes, and LEAST_WORDS for sentences. Rows that repeat id and
    text wholly are one. Null, empty and blank texts have no units; an empty table gives an
    empty one. Rows of units with very many places are not shuffled.

    ``fragments``: parts of the digests' range, by default by the characters of all texts.
    """
    spark = docs.sparkSession
    if unit not in _ENDS:
        raise ValueError(f"unknown unit {unit!r}; use line or sentence")
    if least_words is None:
        least_words = 1 if unit == "line" else LEAST_WORDS
    if fragments is None:
        chars = docs.agg(F.coalesce(F.sum(F.length(F.col(text_col).cast("string"))), F.lit(0))).first()[0]
        fragments = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), chars // _FRAGMENT_CHARS + 1)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text")).where("length(text) > 0").select(
        "id", F.xxhash64("text").alias("h"), "text")
    again = stage(rows.select("text").mapInArrow(_prints(fragments, unit), "part int, prints binary, times binary").groupBy("part").applyInArrow(
        _again, "print bigint, n bigint"), "again")
    # one pass over the texts, merged at every size: repeated units are a share of all units
    found = join_salted(rows.mapInArrow(_places(unit), _PLACE), again.select("print"), "print", again,
                        again.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], "left_semi")
    places = stage(found.drop("print"), "places")
    rank = F.struct(F.col("id").isNull().alias("z"), "id", "h", "no", "start")
    firsts = stage(places.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1"), "firsts")
    hot = hot_keys(firsts, "digest", "n", firsts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    repeats = join_by_key(places, firsts.drop("n"), "digest", hot).where(rank != F.col("first")).dropDuplicates(["id", "h", "no"])
    order = Window.partitionBy("id", "h").orderBy("no")
    run = F.col("no") - F.row_number().over(order)
    return repeats.withColumn("run", run).groupBy("id", "h", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words"), F.count("*").alias("units"),
        F.min_by("first", "no").alias("first")).where(F.col("words") >= least_words).select(
        "id", "h", "start", "end", "words", "units", F.col("first.id").alias("keep_id"), F.col("first.start").alias("keep_start"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line",
                    least_words: int | None = None, removed_col: str = "removed") -> DataFrame:
    """The input rows without these passages, and ``removed_col``: an array of their start and end
    in the original text, null if nothing went. No row goes. An input column of that name is
    refused; choose another."""
    if removed_col in docs.columns:
        raise ValueError(f"the input has a column {removed_col!r}; name another as removed_col")
    gone = repeated_passages(docs, id_col, text_col, unit, least_words).groupBy("id", "h").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__removed"))
    gone = gone.select(F.col("id").alias("__id"), F.col("h").alias("__h"), "__removed").hint("merge")
    text = F.col(text_col)
    joined = docs.join(gone, docs[id_col].cast("bigint").eqNullSafe(F.col("__id")) & (
        F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))) == F.col("__h")), "left")
    # what stays: from the end of each passage to the start of the next
    ends = F.concat(F.array(F.lit(0)), F.transform("__removed", lambda r: r["end"]))
    starts = F.concat(F.transform("__removed", lambda r: r["start"]), F.array(F.length(text)))
    left = F.array_join(F.transform(F.arrays_zip(ends.alias("a"), starts.alias("b")), lambda p: F.substring(
        text, p["a"] + 1, p["b"] - p["a"])), "")
    return joined.withColumn(text_col, F.when(F.col("__removed").isNotNull(), left).otherwise(text)).select(
        *docs.columns, F.col("__removed").alias(removed_col))


@query("op2_substring_dedup")
def op2_substring_dedup(spark, sf_dir):
    found = repeated_passages(table(spark, sf_dir, "documents", "doc_id", "text"), unit="sentence")
    return found.select(F.col("id").alias("doc_id"), "start", "end", "words", "units", "keep_id", "keep_start")
