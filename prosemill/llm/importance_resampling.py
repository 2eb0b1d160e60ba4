"""Importance resampling towards a target: hashed word runs scored by an Aho-Corasick dictionary.

A dictionary of frequent words holds, for each word between delimiters, the CRC-32 of its UTF-8
bytes and their number. One automaton scan of a block of texts emits these payloads; the CRC of
a run of words follows from the payloads of its parts, since CRC-32 of a concatenation is a
linear map of the first CRC, by the length of the second part, and the second CRC. So no run
is ever spelled out. Words outside the dictionary get their payload directly, so it affects
speed only. The same scan counts the buckets of all rows and, with the gains known, scores
each document.
"""

import zlib
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.storage import stage
from .registry import query, table

BUCKETS = 10_000
#: the dictionary holds words above this part of all, hence fewer than so many; the others are hashed one by one
DICTIONARY = 100_000
#: bytes of text in one scan; a longer text is a scan of its own
_BLOCK = 1 << 21
_POLYNOMIAL = 0xEDB88320
_SPACE_CRC = np.uint32(zlib.crc32(b" "))

#: what lies between words once A-Z are lower-cased
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


# ------------------------------------------------------------------ CRC of concatenations


@lru_cache(maxsize=None)
def _zeros(power: int) -> np.ndarray:
    """The effect of 2**power zero bytes on a CRC, as four tables of 256 entries."""
    if power == 0:
        single = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            single = np.where(single & 1, (single >> 1) ^ np.uint32(_POLYNOMIAL), single >> 1).astype(np.uint32)
        low = np.arange(256, dtype=np.uint32)
        return np.stack([single, *(low << np.uint32(8 * (k - 1)) for k in (1, 2, 3))])
    half = _zeros(power - 1)
    return np.stack([_apply(half, _apply(half, np.arange(256, dtype=np.uint32) << np.uint32(8 * k))) for k in range(4)])


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = tables[0][crc & np.uint32(255)]
    for k in (1, 2, 3):
        out ^= tables[k][(crc >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def appended(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of concatenations, from both CRCs and the byte length of the second parts."""
    out, power, left = first.copy(), 0, length.copy()
    while left.any():
        odd = np.flatnonzero(left & 1)
        out[odd] = _apply(_zeros(power), out[odd])
        left >>= 1
        power += 1
    return out ^ second


# ------------------------------------------------------------------------------- scanning


def _payload(word: bytes) -> int:
    return zlib.crc32(word) | len(word) << 32


@lru_cache(maxsize=2)
def _automaton(words: tuple[str, ...]):
    """Automaton of `` word `` patterns over bytes as characters, with payloads."""
    found = ahocorasick.Automaton()
    for word in words:
        raw = word.encode()
        found.add_word(f" {raw.decode('latin-1')} ", _payload(raw))
    if words:
        found.make_automaton()
    return found


def _payloads(raw: bytes, starts: np.ndarray, ends: np.ndarray, words: tuple[str, ...]):
    """(crc, length) of the words of plain text; the dictionary first, then what it lacks."""
    crc, known = np.zeros(len(starts), np.uint32), np.zeros(len(starts), bool)
    if words and len(starts):
        flat = np.fromiter(chain.from_iterable(_automaton(words).iter(raw.decode("latin-1"))), np.int64)
        length = flat[1::2] >> 32
        at = np.searchsorted(starts, flat[::2] - length)
        crc[at], known[at] = flat[1::2] & 0xFFFFFFFF, True
    for i in np.flatnonzero(~known):
        crc[i] = zlib.crc32(raw[starts[i]:ends[i]])
    return crc, ends - starts


def scan(texts: list[bytes], words: tuple[str, ...]):
    """(number of words of each text, [(document, bucket) of all runs of 1, 2 and 3 words])."""
    raw = b" " + b" ".join(texts).translate(_PLAIN) + b" "
    ink = np.frombuffer(raw, np.uint8) != 32
    edges = np.flatnonzero(np.diff(ink.view(np.int8)))
    starts, ends = edges[::2] + 1, edges[1::2] + 1
    crc, length = _payloads(raw, starts, ends, words)
    bounds = np.cumsum([1, *(len(t) + 1 for t in texts)])
    doc = np.searchsorted(bounds, starts, "right") - 1
    space, one = np.full(len(crc), _SPACE_CRC), np.ones(len(crc), np.int64)
    runs, last = [(doc, crc)], crc
    for k in (1, 2):
        # runs of k + 1 words: the run of k that starts here, a space, the word k places on
        head = appended(last[:max(0, len(crc) - k)], space[k:], one[k:])
        last = appended(head, crc[k:], length[k:])
        same = doc[:len(last)] == doc[k:]
        runs.append((doc[:len(last)][same], last[same]))
    return np.bincount(doc, minlength=len(texts)), runs


def _blocks(column: pa.Array):
    """Runs of texts of about ``_BLOCK`` bytes."""
    block, size = [], 0
    for text in column.cast(pa.binary()).to_pylist():
        text = text or b""
        if block and size + len(text) > _BLOCK:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


def _counting(words, buckets: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for block in _blocks(batch["text"]):
                for _, crc in scan(block, words.value)[1]:
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["bucket", "n"])

    return run


def _weighing(words, gains):
    def run(batches):
        for batch in batches:
            counts, weights = [], []
            for block in _blocks(batch["text"]):
                n, runs = scan(block, words.value)
                weight = np.zeros(len(block), np.int64)
                for doc, crc in runs:
                    np.add.at(weight, doc, gains.value[crc % np.uint32(len(gains.value))])
                counts.append(n)
                weights.append(weight)
            if counts:
                yield pa.RecordBatch.from_arrays(
                    [batch["id"], pa.array(np.concatenate(counts)), pa.array(np.concatenate(weights))], names=["id", "words", "weight"])

    return run


# ------------------------------------------------------------------------------ operators


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def frequent_words(docs: DataFrame, text_col: str = "text", most: int = DICTIONARY) -> tuple[str, ...]:
    """The words that are more than one in ``most`` of the words of all rows that occur again:
    fewer than ``most``, however many tasks count them."""
    found = F.explode(F.split(F.translate(_text(text_col), UPPER, LOWER), BETWEEN)).alias("word")
    counts = stage(docs.select(found).where("word <> ''").groupBy("word").agg(F.count("*").alias("n")).where("n > 1"), "words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return tuple(sorted(r.word for r in counts.where((F.col("n") * most > total) & (F.octet_length("word") < 100)).collect()))


def bucket_counts(docs: DataFrame, words, buckets: int = BUCKETS, text_col: str = "text") -> np.ndarray:
    """How often each bucket occurs among the runs of 1 to 3 words of all rows."""
    parts = docs.select(_text(text_col).alias("text")).mapInArrow(_counting(words, buckets), "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[r.bucket] = r.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of the smoothed share in the target over that in the source."""
    n = len(source)
    return np.floor(1000 * np.log((target + 1.0) * (source.sum() + float(n)) / ((source + 1.0) * (target.sum() + float(n))))).astype(np.int64)


def _noise(seed: int) -> Column:
    """A Gumbel draw in thousandths, from a hash of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
                        percent: int = 5, least_words: int = 20, seed: int = 42, buckets: int = BUCKETS,
                        dictionary: int = DICTIONARY) -> DataFrame:
    """Per input row: id, ``n_features``, ``weight``, ``score`` and ``rank``.

    A row's features are all runs of 1 to 3 consecutive words of its whole text, with repeats;
    its weight is the sum of the gains of their buckets, its score adds Gumbel noise of seed and
    id. Of the rows with ``least_words`` words or more, ``percent`` in a hundred, rounded down,
    are drawn: ranks 1, 2, ... go by falling score, ties by smaller id (null ids last), then by
    the text's hash; rows that repeat wholly get a rank each. ``rank`` is null for the others.

    Null and empty texts have no features and weight 0; a null id draws its noise from the
    seed alone. An empty target makes every gain that of smoothing only; an empty table gives
    an empty one. Extra columns are ignored. The driver sees the dictionary and one number a
    bucket. Rows are ordered by ranges of the score, of about a million rows each at most.
    """
    spark = docs.sparkSession
    rows = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(_text(text_col)).alias("h")).alias("id"), _text(text_col).alias("text"))
    words = spark.sparkContext.broadcast(frequent_words(docs, text_col, dictionary))
    gains = spark.sparkContext.broadcast(bucket_gains(
        bucket_counts(docs, words, buckets, text_col), bucket_counts(target, words, buckets, target_col)))
    kind = dict(rows.dtypes)["id"]
    weighed = rows.mapInArrow(_weighing(words, gains), f"id {kind}, words bigint, weight bigint")
    scored = stage(weighed.select("id.id", "id.h", "words", "weight").withColumn("score", F.col("weight") + _noise(seed)), "scored")

    facts = scored.agg(F.count("*"), F.count_if(F.col("words") >= least_words)).first()
    drawn = facts[1] * percent // 100
    order = [F.desc("may"), F.desc("score"), F.asc_nulls_last("id"), F.asc("h")]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), facts[0] // 1_000_000 + 1)
    ranged = scored.withColumn("may", F.col("words") >= least_words).repartitionByRange(parts, *order)
    ranged = stage(ranged.withColumn("part", F.spark_partition_id()), "ranged")
    sizes = sorted((r.part, r.n) for r in ranged.groupBy("part").agg(F.count("*").alias("n")).collect())  # one row a range
    before = dict(zip((p for p, _ in sizes), np.cumsum([0, *(n for _, n in sizes)]).tolist()))
    offset = spark.createDataFrame(list(before.items()), "part int, before bigint")
    ranked = ranged.join(F.broadcast(offset), "part").withColumn(
        "place", F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    n = F.col("words")
    return ranked.select(
        F.col("id").alias(id_col), (n + F.greatest(n - 1, F.lit(0)) + F.greatest(n - 2, F.lit(0))).alias("n_features"),
        "weight", "score", F.when(F.col("may") & (F.col("place") <= drawn), F.col("place")).alias("rank"))


# CRC-32 byte by byte, from a table by rule
_SQL = r"""
WITH RECURSIVE bits(i, k, c) AS (
    SELECT i, 0, i FROM range(256) t(i) UNION ALL
    SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
texts AS MATERIALIZED (
    SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
worded AS MATERIALIZED (SELECT side, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS MATERIALIZED (
    SELECT side, id, unnest(list_concat(w, list_concat(
        list_transform(range(1, len(w)::bigint), lambda i: w[i] || ' ' || w[i + 1]),
        list_transform(range(1, len(w)::bigint - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS run FROM worded),
named AS MATERIALIZED (
    SELECT run, xor(list_reduce(
        list_transform(range(0, strlen(run)), lambda i: ('0x' || substr(hex(encode(run)), (2 * i + 1)::bigint, 2))::bigint),
        lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
    FROM (SELECT DISTINCT run FROM runs), crc),
counted AS MATERIALIZED (
    SELECT bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 'b') AS t FROM runs JOIN named USING (run) GROUP BY bucket),
totals AS (SELECT sum(s)::double AS ss, sum(t)::double AS tt FROM counted),
gains AS MATERIALIZED (
    SELECT bucket, floor(1000 * ln((t + 1)::double * (ss + 10000) / ((s + 1)::double * (tt + 10000))))::bigint AS gain FROM counted, totals),
weights AS (SELECT id, sum(gain)::bigint AS weight FROM runs JOIN named USING (run) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
    SELECT id AS doc_id, len(w)::bigint AS n, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
        (('0x' || substr(sha256('42:' || id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint AS score
    FROM (SELECT * FROM worded WHERE side = 'd') LEFT JOIN weights USING (id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM scored WHERE n >= 20)
SELECT doc_id, n + greatest(n - 1, 0) + greatest(n - 2, 0) AS n_features, weight, score,
    CASE WHEN r <= (SELECT count(*) FROM ranked) * 5 // 100 THEN r END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)"""


@query("op13_importance_resampling", _SQL)
def op13_importance_resampling(spark, sf_dir):
    return importance_resample(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text"))
