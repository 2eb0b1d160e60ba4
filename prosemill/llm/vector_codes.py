"""Vector code compression: a codebook for each part of a vector, searched by equal averages.

Vectors become integers and are cut into equal parts. Each part position has its own codebook,
refined in rounds of assignment and averaging. The nearest entry of a part is found among the
entries sorted by component sum: from the part's own sum the search goes outward on both sides
until the squared gap of the sums over the dimension, a lower bound of the squared distance,
strictly exceeds the best distance. A round returns one sum per task and entry to Spark.
"""

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hot_keys, join_by_key
from ..sources.storage import stage
from .registry import query, table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024


@dataclass(frozen=True)
class Codebooks:
    """``entries[p]``: the integer entries of part position ``p``, one row each; ``length`` of
    the vectors they stand for, which zeros fill up to equal parts."""

    entries: tuple[np.ndarray, ...]
    length: int

    def sha256(self) -> str:
        """Digest of all components by part, entry and position, as decimals with commas."""
        return hashlib.sha256(",".join(str(x) for book in self.entries for x in book.ravel().tolist()).encode()).hexdigest()

    def vector(self, code: Column, scale: int = SCALE) -> Column:
        """The vector (array<double>) that a code of hex digits stands for."""
        books = F.array(*(F.array(*(F.array(*(F.lit(int(x)) for x in row)) for row in book)) for book in self.entries))
        each = F.transform(F.sequence(F.lit(0), F.lit(len(self.entries) - 1)), lambda p: F.get(
            F.get(books, p), F.conv(F.substring(code, 2 * p + 1, F.lit(2)), 16, 10).cast("int")))
        return F.slice(F.transform(F.flatten(each), lambda x: x / F.lit(float(scale))), 1, self.length)


# --------------------------------------------------------------------------------- search


#: rows of similar sums that search together, entries that a step outward adds
_TILE, _STEP = 256, 16


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index of the nearest entry, squared distance) of each row of ``parts``, ties to the
    lower index; and how many distances were computed.

    Rows are taken in the order of their sums, a tile at a time, so that the entries next to
    one row's sum are those next to the others', and a step outward is one matrix product.
    """
    width, size = book.shape[1], len(book)
    exact = width * (2.0 * max((np.abs(x).max(initial=0) for x in (parts, book)), default=0)) ** 2 < 2.0**53
    kind = np.float64 if exact else np.int64
    order = np.argsort(book.sum(1), kind="stable")
    entries, sums = book[order].astype(kind), book.sum(1)[order]
    squares, own = (entries * entries).sum(1), parts.sum(1)
    found, best, computed = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64), 0
    rows_by_sum = np.argsort(own, kind="stable")
    for first in range(0, len(parts), _TILE):
        rows = rows_by_sum[first:first + _TILE]
        x, at = parts[rows].astype(kind), own[rows]
        norm = (x * x).sum(1)
        low, name = np.full(len(rows), np.inf if exact else np.iinfo(np.int64).max, kind), np.full(len(rows), size)

        def look(here, begin, end):
            off = norm[here, None] - 2 * (x[here] @ entries[begin:end].T) + squares[begin:end]
            least = off.min(1)
            which = np.where(off == least[:, None], order[begin:end], size).min(1)
            better = (least < low[here]) | ((least == low[here]) & (which < name[here]))
            low[here[better]], name[here[better]] = least[better], which[better]
            return off.size

        begin, end = np.searchsorted(sums, at[0]), np.searchsorted(sums, at[-1], "right")
        if begin < end:
            computed += look(np.arange(len(rows)), begin, end)
        while begin > 0 or end < size:
            # the margin is that of rounding: a tie is never cut off
            bound = low.astype(float) * width * (1 + 1e-12)
            more = begin, end
            if end < size:
                here = np.flatnonzero((sums[end] - at).astype(float) ** 2 <= bound)
                end = min(size, end + _STEP) if len(here) else size
                computed += look(here, more[1], end) if len(here) else 0
            if begin > 0:
                here = np.flatnonzero((at - sums[begin - 1]).astype(float) ** 2 <= bound)
                begin = max(0, begin - _STEP) if len(here) else 0
                computed += look(here, begin, more[0]) if len(here) else 0
        found[rows], best[rows] = name, low
    return found, best, computed


def _cut(vectors: pa.Array, parts: int) -> np.ndarray:
    """(row, part, component) of a batch of integer vectors of one length."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if len(flat) and len(flat) // len(vectors) * (2.0 * np.abs(flat).max()) ** 2 >= 2.0**63:
        raise ValueError("components are too large for squared distances of 64 bits")
    return flat.reshape(len(vectors), parts, -1)


def _summing(books):
    def run(batches):
        total = [np.zeros_like(b) for b in books.value]
        count = [np.zeros(len(b), np.int64) for b in books.value]
        for batch in batches:
            if batch.num_rows:
                cut = _cut(batch["v"], len(total))
                for p, book in enumerate(books.value):
                    found = nearest(cut[:, p], book)[0]
                    np.add.at(total[p], found, cut[:, p])
                    count[p] += np.bincount(found, minlength=len(book))
        rows = [{"part": p, "entry": int(e), "n": int(count[p][e]), "total": total[p][e].tolist()}
                for p in range(len(total)) for e in np.flatnonzero(count[p])]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([
            ("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))]))

    return run


def _coding(books):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                cut = _cut(batch["v"], len(books.value))
                found, error = zip(*(nearest(cut[:, p], book)[:2] for p, book in enumerate(books.value)))
                codes = [bytes(row).hex() for row in np.stack(found, 1).astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [batch["id"], batch["label"], pa.array(codes), pa.array(np.sum(error, 0))], names=["id", "label", "code", "error"])

    return run


# ------------------------------------------------------------------------------ operators


def _integers(df: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int, scale: int):
    """(staged rows of id, label and integer vector ``v``, length before filling up)."""
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.where(finite & (F.size(vector) > 0)).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).alias("label"),
        F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"))
    first = rows.orderBy(F.asc_nulls_last("id"), "v").select(F.size("v").alias("n")).first()
    length = first["n"] if first else parts
    filled = F.concat("v", F.array_repeat(F.lit(0).cast("bigint"), -length % parts)) if length % parts else F.col("v")
    return stage(rows.where(F.size("v") == length).withColumn("v", filled), "vectors"), length


def _fit(rows: DataFrame, length: int, parts: int, entries: int, rounds: int) -> Codebooks:
    spark, width = rows.sparkSession, -(-length // parts)
    first = rows.orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").collect()
    start = np.array([r.v for r in first], np.int64).reshape(len(first), parts, width)
    books = [start[:, p].copy() for p in range(parts)]
    for _ in range(rounds if len(first) else 0):
        shared = spark.sparkContext.broadcast(books)
        sums = rows.select("v").mapInArrow(_summing(shared), "part int, entry int, n bigint, total array<bigint>")
        merged = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*(
            F.sum(F.get("total", i)) for i in range(width))).alias("total"))
        books = [b.copy() for b in books]
        for r in merged.collect():  # a row an entry
            books[r.part][r.entry] = [x // r.n for x in r.total]
    return Codebooks(tuple(books), length)


def fit_codebooks(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                  parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """The codebooks of :func:`compress_vectors`, learned from all rows that it codes."""
    rows, length = _integers(df, id_col, vector_col, label_col, parts, scale)
    return _fit(rows, length, parts, entries, rounds)


def compress_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                     parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """Per coded row: id, ``code``, ``error``, ``label_error`` and ``codebooks_sha256``.

    Components become floor(scale * x). The codebook of a part position starts as that part of
    the ``entries`` rows with the smallest ids (null ids last, ties by vector); a round assigns
    every part to the nearest entry (squared distance, ties to the lower index) and replaces
    each entry by the floor of the mean of its parts; unused entries stay. ``error`` sums the
    squared distances of the final assignment, ``label_error`` the errors of rows with the same
    label, null labels together. At most 256 entries, so a part's index has two hex digits.

    Rows whose vector is null or empty or holds a null, NaN or infinite component are left out,
    and so are vectors of another length than that of the smallest id: no codebook fits them.
    A length that ``parts`` does not divide is filled up with zeros. Repeated rows are rows of
    their own. Components so large that squared distances leave 64 bits are an error. An empty
    table gives an empty one; extra columns are ignored.

    The driver sees the codebooks and, in each round, one sum per entry. The sum of a label is
    taken before it is joined, and rows of frequent labels are not shuffled.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    rows, length = _integers(df, id_col, vector_col, label_col, parts, scale)
    books = _fit(rows, length, parts, entries, rounds)
    shared = df.sparkSession.sparkContext.broadcast(list(books.entries))
    kind = dict(rows.dtypes)["label"]
    coded = stage(rows.mapInArrow(_coding(shared), f"id bigint, label {kind}, code string, error bigint"), "codes")
    # as a string, so that null is a key like any other
    keyed = coded.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")))
    sums = stage(keyed.groupBy("key").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "labels")
    hot = hot_keys(sums, "key", "n", sums.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    return join_by_key(keyed, sums.drop("n"), "key", hot).select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _sql() -> str:
    steps = []
    for k in range(ROUNDS + 1):
        steps.append(f"""
        a{k} AS MATERIALIZED (
            SELECT vec_id, p, x, arg_min(e, d * 1000 + e) AS e, min(d) AS d FROM (
                SELECT vec_id, p, x, e, xx - 2 * list_dot_product(xd, cd) + cc AS d FROM parts JOIN b{k} USING (p))
            GROUP BY vec_id, p, x)""")
        if k < ROUNDS:
            steps.append(f"""
        m{k} AS (SELECT p, e, list(v ORDER BY i) AS c FROM (
            SELECT p, e, i, floor(sum(x[i])::double / count(*))::bigint AS v FROM a{k}, (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM parts))) AS i)
            GROUP BY p, e, i) GROUP BY p, e),
        b{k + 1} AS MATERIALIZED (SELECT p, e, c, c::double[] AS cd, list_dot_product(c::double[], c::double[]) AS cc
            FROM (SELECT p, e, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN m{k} m USING (p, e)))""")
    return f"""
    WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (SELECT *, x::double[] AS xd, list_dot_product(x::double[], x::double[]) AS xx FROM (
        SELECT vec_id, p, v[(p * len(v) // {PARTS} + 1):((p + 1) * len(v) // {PARTS})] AS x FROM kept, range({PARTS}) t(p))),
    b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c, xd AS cd, xx AS cc FROM parts
        QUALIFY e < {ENTRIES}),{",".join(steps)},
    coded AS (SELECT vec_id, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, sum(d)::bigint AS error FROM a{ROUNDS} GROUP BY vec_id)
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::bigint AS label_error,
        (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b{ROUNDS}) AS codebooks_sha256
    FROM coded JOIN kept USING (vec_id)"""


@query("op12_vector_codes", _sql())
def op12_vector_codes(spark, sf_dir):
    return compress_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
