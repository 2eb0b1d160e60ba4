"""Exact dedup by an exchange of compressed fingerprints.

Every task sorts fixed-width fingerprints of its rows and sends each owner (a range of
fingerprints) a Golomb-coded list of its distinct ones, about four bytes each, so a text of a
third of all rows costs an owner one entry per list. Owners answer each list with a bitmap
of the fingerprints that somebody else has again. Rows with such a bit, and those whose own list
has several of one fingerprint, are suspects; their texts are shuffled and compared byte by byte.
"""

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hot_keys, join_by_key
from ..sources.storage import stage
from .registry import query, table

#: bits of a fingerprint, rows of a list
_BITS, _ROWS = 48, 200_000


def golomb_encode(values: np.ndarray, low: int) -> bytes:
    """Sorted integers from ``low`` on -> header, unary quotients, fixed-width remainders of their gaps."""
    gaps = np.diff(values, prepend=low).astype(np.uint64)
    k = max(0, int(gaps.mean()).bit_length() - 1)
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    ones = np.cumsum(quotient + 1) - 1
    unary = np.zeros(int(ones[-1]) + 1, np.uint8)
    unary[ones] = 1
    rest = (gaps[:, None] >> np.arange(k, dtype=np.uint64)[::-1] & np.uint64(1)).astype(np.uint8)
    unary = np.packbits(unary)
    return np.array([len(values), k, len(unary)], "<i8").tobytes() + unary.tobytes() + np.packbits(rest).tobytes()


def golomb_decode(blob: bytes, low: int) -> np.ndarray:
    n, k, size = (int(x) for x in np.frombuffer(blob, "<i8", 3))
    unary = np.unpackbits(np.frombuffer(blob, np.uint8, size, 24))
    quotient = np.diff(np.flatnonzero(unary)[:n], prepend=-1) - 1
    rest = np.unpackbits(np.frombuffer(blob, np.uint8, offset=24 + size), count=n * k).reshape(n, k).astype(np.int64)
    return low + np.cumsum((quotient << k) + rest @ (1 << np.arange(k, dtype=np.int64)[::-1]))


def _low(owner: int, owners: int) -> int:
    return -(-(owner << _BITS) // owners)


_ROW = pa.struct([("id", pa.int64()), ("size", pa.int64()), ("h", pa.int64()), ("digest", pa.binary()),
                  ("at", pa.int32()), ("several", pa.bool_())])
#: a row's fingerprint is the one numbered ``at`` of its list; ``several``: it isn't the only row there
_LISTS = ("owner int, list string, coded binary, "
          "docs array<struct<id bigint, size bigint, h bigint, digest binary, at int, several boolean>>")


def _lists(owners: int):
    """Rows (id, size, h, digest) -> one list per owner, its rows in the order of the fingerprints."""
    def cut(rows):
        name = uuid.uuid4().hex
        t = pa.Table.from_batches(rows)
        prints = np.frombuffer(b"".join(x[:8] for x in t["digest"].to_pylist()), ">u8") >> np.uint64(64 - _BITS)
        order = np.argsort(prints, kind="stable")
        prints = prints[order].astype(np.int64)
        t = t.take(pa.array(order)).combine_chunks()
        first = np.ones(len(prints), bool)
        np.not_equal(prints[1:], prints[:-1], out=first[1:])
        group = np.cumsum(first) - 1
        several = np.bincount(group)[group] > 1
        edges = np.searchsorted(prints, [_low(o, owners) for o in range(owners)] + [1 << _BITS])
        own = [o for o in range(owners) if edges[o] < edges[o + 1]]
        at = group - np.repeat(group[edges[own]], edges[np.array(own) + 1] - edges[own])
        struct = pa.StructArray.from_arrays([*(t[c].combine_chunks() for c in ("id", "size", "h", "digest")),
                                             pa.array(at, pa.int32()), pa.array(several)], fields=list(_ROW))
        starts = pa.array([*(edges[o] for o in own), len(prints)], pa.int32())
        yield pa.RecordBatch.from_arrays([
            pa.array(own, pa.int32()), pa.array([name] * len(own)),
            pa.array([golomb_encode(np.unique(prints[edges[o]:edges[o + 1]]), _low(o, owners)) for o in own], pa.binary()),
            pa.ListArray.from_arrays(starts, struct)], names=["owner", "list", "coded", "docs"])

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows.append(batch)
            size += batch.num_rows
            if size >= _ROWS:
                yield from cut(rows)
                rows, size = [], 0
        if rows:
            yield from cut(rows)

    return run


def _answers(owners: int):
    def run(key, t):
        low = _low(key[0].as_py(), owners)
        lists = [golomb_decode(x, low) for x in t["coded"].to_pylist()]
        _, where, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        bits = np.split(count[where] > 1, np.cumsum([len(x) for x in lists])[:-1])
        hit = pa.array([i for i, b in enumerate(bits) if b.any()], pa.int64())
        return pa.table({"owner": t["owner"].take(hit), "list": t["list"].take(hit),
                         "again": pa.array([np.packbits(b).tobytes() for b in bits if b.any()], pa.binary())})

    return run


#: rows for each owner of fingerprints, at most
_OWN = 2_000_000


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owners: int | None = None) -> DataFrame:
    """Per input row: id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal if they agree after all of ``[\\x20\\x09-\\x0D]`` is deleted; a null text
    counts as empty. Of equal texts the row with the most code points of the original text
    stays, then the smallest id, null ids last; of rows that agree in all this exactly one
    stays. ``keep_id`` is the id of the row that stays (null if that row has none). Extra
    columns are ignored; an empty table gives an empty one.

    ``owners``: ranges of fingerprints, by default by the number of rows, so that an owner decodes
    two million of them at most, however large the input is.
    """
    spark = docs.sparkSession
    if owners is None:
        owners = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), docs.count() // _OWN + 1)
    plain = F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    lists = stage(rows.select("id", F.length("text").cast("bigint").alias("size"), "h", F.unhex(F.sha2(plain, 256)).alias("digest"))
                  .mapInArrow(_lists(owners), _LISTS), "lists")
    answers = lists.select("owner", "list", "coded").groupBy("owner").applyInArrow(
        _answers(owners), "owner int, list string, again binary")
    # bit i of a packed bitmap belongs to fingerprint i of the list
    marked = lists.select("owner", "list", "docs").join(answers, ["owner", "list"], "left").select(
        "again", F.explode("docs").alias("doc")).select("again", "doc.*")
    suspects = stage(marked.where(F.col("several") | F.expr(
        "again is not null and (cast(conv(hex(substring(again, cast(at div 8 as int) + 1, 1)), 16, 10) as int) >> (7 - at % 8)) & 1 = 1")).select(
        "id", "h"), "suspects")
    # merged at every size: a broadcast that fits small inputs only would hide this shuffle
    texts = rows.join(suspects.select(F.col("id").alias("sid"), F.col("h").alias("sh")).hint("merge"),
                      rows["id"].eqNullSafe(F.col("sid")) & (rows["h"] == F.col("sh")), "left_semi")
    same = texts.select(plain.alias("plain")).withColumn("digest", F.unhex(F.sha2("plain", 256))).groupBy("digest", "plain").agg(
        F.count("*").alias("rows"))
    verified = same.groupBy("digest").agg(F.sum("rows").alias("rows"), F.count("*").alias("texts")).where("rows > 1").select(
        "digest", F.when(F.col("texts") == 1, True).otherwise(F.raise_error(F.lit("two texts share a SHA-256"))).alias("ok")).where("ok")

    each = lists.select("owner", "list", F.posexplode("docs").alias("i", "doc")).select(
        "doc.*", F.struct("owner", "list", "i").alias("row"))
    best = F.struct((-F.col("size")).alias("s"), F.col("id").isNull().alias("z"), "id", "row")
    # counted before the join, so that a large group comes as one row per task
    keep = each.groupBy("digest").agg(F.min(best).alias("best"), F.count("*").alias("group_size")).where(
        "group_size > 1").join(verified.select("digest"), "digest", "left_semi")
    keep = stage(keep, "keep")
    hot = hot_keys(keep, "digest", "group_size", keep.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0])
    out = join_by_key(each, keep, "digest", hot, "left")
    lone = F.col("best").isNull()
    return out.select(
        F.col("id").alias(id_col), F.when(lone, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (lone | (F.col("row") == F.col("best.row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
    doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id ROWS UNBOUNDED PRECEDING)"""


@query("op8_exact_dedup", _SQL)
def op8_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))
