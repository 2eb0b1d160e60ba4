import hashlib
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from prosemill.functions import minhash as M
from prosemill.functions import text as X
from prosemill.operators import dedup as D
from prosemill.operators import joins as J
from prosemill.sources.storage import stage
from prosemill.streaming.dedup_stream import dedup_exact_stream, run_available
from tests.conftest import plan_of

# ------------------------------------------------------------------------------ exact


def test_q1_one_row_per_id_wherever_the_copies_are(spark):
    rows = [(i, f"t{i % 50}") for i in range(1000)] + [(2000 + i, "t7") for i in range(500)]
    df = spark.createDataFrame(rows, "ord bigint, text string").withColumn("doc_id", F.md5("text"))
    for parts in (1, 3, 17):
        out = D.dedup_exact(df.repartition(parts), ["ord"])
        assert sorted((r.ord, r.text) for r in out.collect()) == [(i, f"t{i}") for i in range(50)]  # Q2


def test_exact_ties_in_the_order_key_still_leave_one_row(spark):
    df = spark.createDataFrame([("a", 1, "u2"), ("a", 1, "u1"), ("a", 1, "u1")], "doc_id string, ord int, url string")
    urls = {D.dedup_exact(df.repartition(n), ["ord"]).first().url for n in (1, 2, 3)}
    assert len(urls) == 1 and urls < {"u1", "u2"}


def test_the_time_of_ingestion_does_not_choose_a_copy(spark):
    rows = [("a", f"u{i}") for i in range(12)]
    kept = set()
    for now in range(12):
        df = spark.createDataFrame(rows, "doc_id string, url string").withColumn("ingest_time", F.lit(float(now)))
        kept.add(D.dedup_exact(df.repartition(3), []).first().url)
    assert len(kept) == 1


def test_q4_ids_describe_the_ingested_text(spark):
    from prosemill.operators.ingest import IngestConfig, ingest
    from prosemill.operators.quality import quality_filter

    text = "the words of the text and the mail {} of the person that is in the list of the mail to the others in it"
    raw = spark.createDataFrame([(text.format("a@b.co"),), (text.format("c@d.co"),)], "text string")
    out = quality_filter(ingest(raw, IngestConfig(input_path="x"))).collect()
    assert len({r.text for r in out}) == 1 and len({r.doc_id for r in out}) == 2
    assert out[0].char_count == len(text.format("a@b.co"))


def test_exact_reduces_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("doc_id"), "id")
    plan = plan_of(D.dedup_exact(df, ["id"]))
    shuffle = plan.index("Exchange hashpartitioning(doc_id")
    assert "WindowGroupLimit" in plan[shuffle:]  # below, that is before


def test_exact_without_id_passes(spark):
    df = spark.createDataFrame([(1,), (1,)], "n int")
    assert D.dedup_exact(df, ["n"]).count() == 2


# --------------------------------------------------------------------------- shingles

SHINGLES = [
    ("", set()), ("!!", set()), ("! !", {" "}), ("one", {"one"}), (" a  b ", {" a  b "}),
    ("a b c d", {"a b c d"}), ("A, b. c d e", {"a b c d e"}),
    ("a b c d e f", {"a b c d e", "b c d e f"}), ("x x x x x x x", {"x x x x x"}),
    ("foo_bar é 1 ² z w", {"foo_bar é 1 ² z", "é 1 ² z w"}),
    ("  lead in to the five words", {"lead in to the five", "in to the five words"}),
]


def test_shingles_native(apply):
    assert [set(s) for s in apply(X.shingles, [t for t, _ in SHINGLES])] == [w for _, w in SHINGLES]


# -------------------------------------------------------------------------- signatures


def naive_sha1_signature(grams, num_perm, seed):
    prime, top = (1 << 61) - 1, (1 << 32) - 1
    draw = np.random.RandomState(seed)
    pairs = [(int(draw.randint(1, prime, dtype=np.uint64)), int(draw.randint(0, prime, dtype=np.uint64)))
             for _ in range(num_perm)]
    hashes = [struct.unpack("<I", hashlib.sha1(g.encode()).digest()[:4])[0] for g in grams]
    return [min((((a * h + b) % (1 << 64)) % prime) & top for h in hashes) for a, b in pairs]


def naive_hashes(grams):
    return np.array([struct.unpack("<I", hashlib.sha1(g.encode()).digest()[:4])[0] for g in sorted(grams)])


def test_signature_equals_a_big_integer_computation():
    grams = {f"gram {i} é" for i in range(300)}
    for chunk in (7, 2048):
        assert M.signature(naive_hashes(grams), "sha1", 64, 42, chunk).tolist() == naive_sha1_signature(grams, 64, 42)


def test_signature_column_and_families(spark, apply):
    def signatures(texts, **options):
        hashes = apply(lambda c: M.shingle_hashes(c, family=options.get("family", "sha1")), texts)
        df = spark.createDataFrame(list(enumerate(hashes)), "i int, h array<bigint>")
        return [r.s for r in df.select("i", M.minhash(**options)("h").alias("s")).orderBy("i").collect()]

    text = "the quick brown fox jumps over the lazy dog"
    (grams,) = apply(X.shingles, [text])
    (sha1,) = signatures([text], num_perm=16)
    assert sha1 == naive_sha1_signature(grams, 16, 42)
    (md5,) = signatures([text], num_perm=16, family="md5")
    assert md5 != sha1 and all(0 <= v < 2**31 - 1 for v in md5)
    assert signatures(["!!", None, text], num_perm=16) == [None, None, sha1]
    assert sorted(apply(M.shingle_hashes, [text])[0]) == sorted(naive_hashes(grams).tolist())
    with pytest.raises(ValueError):
        M.coefficients("crc", 4, 1)
    with pytest.raises(ValueError):
        M.shingle_hashes(F.col("text"), 5, "crc")


def test_native_hash_family(spark, apply):
    text = "the quick brown fox jumps over the lazy dog"
    (grams,) = apply(X.shingles, [text])
    (hashes,) = apply(lambda c: M.shingle_hashes(c, family="xxhash64"), [text])
    native = {r.g: r.h & 0xFFFFFFFF for r in spark.createDataFrame([(g,) for g in grams], "g string").select("g", F.xxhash64("g").alias("h")).collect()}
    assert hashes == [native[g] for g in grams]
    prime, (a, b) = (1 << 61) - 1, M.coefficients("xxhash64", 16, 42)
    want = [min((((int(x) * h + int(y)) % (1 << 64)) % prime) & 0xFFFFFFFF for h in hashes) for x, y in zip(a, b)]
    assert M.signature(np.array(hashes), "xxhash64", 16, 42).tolist() == want


def test_no_text_enters_python(spark):
    df = spark.createDataFrame([(1, "a b c d e f")], "doc_id bigint, text string")
    plan = plan_of(D.DedupConfig().with_buckets(df).select("doc_id", "buckets"))
    at = plan.index("ArrowEvalPython")
    assert "text" not in plan[at:plan.index("\n", at)] and "_hashes" in plan[at:plan.index("\n", at)]
    assert dict(df.select(M.shingle_hashes(F.col("text")).alias("h")).dtypes) == {"h": "array<bigint>"}


@pytest.mark.parametrize("threshold, bands, rows", [(0.85, 8, 16), (0.8, 9, 13), (0.7, 14, 9), (0.9, 5, 25)])
def test_band_choice(threshold, bands, rows):
    assert M.best_bands(threshold, 128) == (bands, rows)


def test_equal_texts_share_all_buckets_and_others_none(spark):
    texts = ["a b c d e f", "A b, c d e f!", "u v w x y z", "??"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = D.DedupConfig().with_buckets(df).orderBy("i").collect()
    one, same, other, none = (r.buckets for r in rows)
    assert one == same and len(one) == 8 and not set(one) & set(other) and none == []


def test_config_warnings():
    with pytest.warns(UserWarning, match="num_perm"):
        D.DedupConfig(num_perm=32)
    with pytest.warns(UserWarning, match="threshold"):
        D.DedupConfig(threshold=0.5)


# ------------------------------------------------------------------------ greedy choice


def sequential(rows):
    """Documents dropped by a walk in order."""
    buckets = {}
    for doc, bucket in rows:
        buckets.setdefault(doc, set()).add(bucket)
    held, dropped = set(), set()
    for doc in sorted(buckets):
        if held & buckets[doc]:
            dropped.add(doc)
        else:
            held |= buckets[doc]
    return dropped


def dropped_of(spark, rows, **kw):
    members = stage(spark.createDataFrame(rows, "doc bigint, bucket string"), "m")
    return {r.doc for r in D.first_wins(members, **kw).collect()}


def test_chain_keeps_every_other_document(spark):
    rows = [(d, b) for d in range(7) for b in (f"b{d}", f"b{d + 1}")]  # 0~1~2~...~6
    assert dropped_of(spark, rows) == {1, 3, 5}


@pytest.mark.parametrize("seed", range(4))
def test_rounds_equal_the_sequential_walk(spark, seed):
    # many small graphs in one table: graph g uses its own documents and buckets
    rng = random.Random(seed)
    rows = set()
    for g in range(150):
        for d in range(rng.randint(1, 12)):
            for _ in range(rng.randint(1, 3)):
                rows.add((g * 100 + d, f"{g}-{rng.randint(0, 6)}"))
    assert dropped_of(spark, sorted(rows)) == sequential(rows)


def test_long_chain_in_hash_order_takes_few_rounds(spark, monkeypatch):
    chain = spark.range(20_000).select(F.xxhash64("id").alias("doc"), F.explode(F.array("id", F.col("id") + 1)).alias("bucket"))
    rounds = []
    settle = D._settle_round
    monkeypatch.setattr(D, "_settle_round", lambda *a: rounds.append(1) or settle(*a))
    dropped = D.first_wins(stage(chain, "m"))
    kept = stage(chain.join(dropped, "doc", "left_anti"), "kept")
    assert kept.groupBy("bucket").count().where("count > 1").count() == 0  # no two kept ones share a bucket
    hit = chain.join(dropped, "doc", "left_semi").join(kept.select("bucket").distinct(), "bucket", "left_semi")
    assert hit.select("doc").distinct().count() == dropped.count()  # every dropped one shares one with a kept
    assert len(rounds) <= 8


def test_hot_bucket_is_one_round(spark):
    hot = spark.range(10_000).select(F.col("id").alias("doc"), F.lit("hot").alias("bucket"))
    own = spark.range(10_000).select(F.col("id").alias("doc"), F.concat(F.lit("own"), "id").alias("bucket"))
    conflicts = D.shared_members(stage(hot.unionByName(own), "m"))
    assert conflicts.count() == 10_000
    dropped = D.first_wins(conflicts)
    assert dropped.count() == 9_999 and dropped.where("doc = 0").count() == 0
    matches = D.kept_match(conflicts, dropped)
    assert matches.count() == 9_999 and matches.where("kept_doc <> 0").count() == 0


def test_no_conflicts(spark):
    assert dropped_of(spark, [(1, "a"), (2, "b")]) == set()
    assert dropped_of(spark, []) == set()


def test_struct_order_keys(spark):
    base = "one two three four five six seven eight nine ten"
    rows = [("s2", "u", "d1", base), ("s1", "v", "d2", base), ("s1", "u", "d3", base + "!"), ("s3", None, "d4", "other words in this text here")]
    df = spark.createDataFrame(rows, "source string, url string, doc_id string, text string")
    assert {r.doc_id for r in D.dedup_fuzzy(df, ["source", "url"]).collect()} == {"d3", "d4"}
    match = {(r.doc.doc_id, r.kept_doc.doc_id) for r in D.near_dup_matches(df, ["source", "url"]).collect()}
    assert match == {("d1", "d3"), ("d2", "d3")}


def near_copies(spark):
    rng = random.Random(5)
    docs, texts = [], []
    for i in range(120):
        if texts and rng.random() < 0.5:
            words = rng.choice(texts).split()
            words[rng.randrange(len(words))] = f"w{i}"
            text = " ".join(words)
        else:
            text = " ".join(rng.choices([f"v{k}" for k in range(500)], k=80))
        texts.append(text)
        docs.append((i, text))
    return docs


def test_fuzzy_equals_the_walk_whatever_the_partitioning(spark):
    docs = near_copies(spark)
    cfg = D.DedupConfig(threshold=0.7)
    bands, rows = cfg.bands()
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    grams = {r.doc_id: r.g for r in df.select("doc_id", X.shingles(F.col("text")).alias("g")).collect()}
    keys = {i: M.bucket_keys(np.array(naive_sha1_signature(g, 128, 42)), bands, rows) for i, g in grams.items()}
    members = [(i, k) for i, _ in docs for k in keys[i]]
    want = {i for i, _ in docs} - sequential(members)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    for parts in (1, 5):
        out = D.dedup_fuzzy(df.repartition(parts), ["doc_id"], cfg)
        assert {r.doc_id for r in out.collect()} == want
    assert 0 < len(want) < len(docs)
    again = D.dedup_fuzzy(stage(out, "kept"), ["doc_id"], cfg)
    assert again.count() == len(want)  # idempotent


def test_one_text_shuffle(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(f"d{i}", f"s{i % 3}", " ".join(f"w{k}" for k in range(i % 7, 30))) for i in range(40)],
                                   "doc_id string, source string, text string")
        exact = plan_of(D.dedup_exact(df, ["source"]))
        assert not [x for x in exact.split("\n") if "Sort [" in x and "text" in x.split("Sort [")[1].split("]")[0].split("xxhash64")[0]]
        plan = plan_of(D.dedup(df, []))
        for line in plan.split("\n"):
            assert "Exchange" not in line or "text" not in line
        side = plan[plan.index("LeftAnti"):].split("\n")
        scan = next(i for i, x in enumerate(side) if "text" in x and "FileScan" in x)
        assert not any("Exchange" in x for x in side[1:scan])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_dedup_disabled_and_without_columns(spark):
    df = spark.createDataFrame([("a", "t"), ("a", "t")], "doc_id string, text string")
    assert D.dedup(df, [], D.DedupConfig(enabled=False)).count() == 2
    assert D.dedup(df, []).count() == 1
    assert D.dedup(df.drop("text"), []).count() == 1
    assert D.dedup_fuzzy(df.drop("text"), []).count() == 2


def test_documents_without_shingles_pass(spark):
    df = spark.createDataFrame([(1, "!!"), (2, "!!"), (3, None)], "doc_id int, text string")
    assert D.dedup_fuzzy(df, ["doc_id"]).count() == 3


# ------------------------------------------------------------------------------- joins


@pytest.mark.parametrize("slices", [1, 3, 5_000])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_join_by_key_equals_a_join(spark, monkeypatch, how, slices):
    monkeypatch.setattr(J, "HOT_SLICES", slices)
    left = spark.range(300).select(F.when(F.col("id") < 200, 0).otherwise(F.col("id") % 7).alias("k"), "id")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (9, "d")], "k bigint, v string")
    counts = left.groupBy("k").count()
    got = J.join_by_key(left, right, "k", J.hot_keys(counts, "k", "count", 300), how)
    want = left.join(right, "k", how)
    assert sorted(map(tuple, got.select(want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_hot_keys_are_few(spark):
    counts = spark.range(1, 2000).select(F.col("id").alias("k"), F.col("id").alias("n"))
    total = counts.agg(F.sum("n")).first()[0]
    assert 0 < J.hot_keys(counts, "k", "n", total).count() < J.HOT_SLICES


@pytest.mark.parametrize("size", [1, 2, 9, 10, 501])
def test_int_median(spark, size):
    import statistics

    rng = random.Random(size)
    values = [rng.choice([0, 3, 4095, 4096, 9000, rng.randint(0, 20_000)]) for _ in range(size)]
    df = spark.createDataFrame([("g", v) for v in values] + [("h", 5), ("n", None)], "g string, v bigint")
    got = {r.g: r.median for r in J.int_median(df, "g", "v").collect()}
    assert got == {"g": statistics.median(values), "h": 5.0}


# ----------------------------------------------------------------------------- stream


def test_stream_and_table_agree_on_the_ids(spark, tmp_path):
    df = spark.range(60).select(F.md5((F.col("id") % 13).cast("string")).alias("doc_id"), "id")
    for part in range(3):
        df.where(F.col("id") % 3 == part).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    run_available(dedup_exact_stream(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    out = spark.read.parquet(str(tmp_path / "out"))
    want = D.dedup_exact(df, ["id"])
    assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in want.collect())
    assert dedup_exact_stream(stream.drop("doc_id")).columns == ["id"]


def test_md5_signature_at_the_ends_of_its_numbers():
    """Folding instead of a division gives the remainders, also for the least and largest hashes."""
    a, b = M.coefficients("md5", 64, 42)
    for base in ([0], [(1 << 28) - 1], [0, 1, 2, (1 << 28) - 1, 123_456_789] * 60):
        want = [min((int(x) * h + int(y)) % ((1 << 31) - 1) for h in base) for x, y in zip(a, b)]
        assert [M.signature(np.array(base), "md5", 64, 42, chunk).tolist() for chunk in (1, 7, 256)] == [want] * 3
