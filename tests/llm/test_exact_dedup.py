import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from prosemill.llm.exact_dedup import exact_dedup, golomb_decode, golomb_encode


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute(docs):
    groups = {}
    for i, t in docs:
        groups.setdefault(plain(t), []).append((-len(t or ""), i is None, i))
    return sorted(((i, min(g := groups[plain(t)])[2], len(g), (-len(t or ""), i is None, i) == min(g),
                    hashlib.sha256(plain(t).encode()).hexdigest()) for i, t in docs), key=repr)


def test_equals_brute_force(spark):
    rng = random.Random(4)
    texts = ["", None, " ", "\t\n", "a b", "ab", " a  b ", "A b", "é x", "é x", "x" * 200_000, "x" * 200_000 + " "]
    docs = [(i, rng.choice(texts) if i % 3 else f"text {i}") for i in range(900)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    df = df.withColumn("size", F.lit(0)).withColumn("digest", F.lit("x")).withColumn("keep_id", F.lit(1))
    got = sorted((tuple(r) for r in exact_dedup(df).collect()), key=repr)
    assert got == brute(docs)


def test_equal_rows_and_null_ids_keep_one(spark):
    docs = [(1, "a"), (1, "a"), (None, "a "), (None, "a "), (None, "b"), (2, "b"), (3, "c")]
    got = exact_dedup(spark.createDataFrame(docs, "doc_id bigint, text string"))
    rows = got.select("doc_id", "keep_id", "group_size", "kept").collect()
    assert sum(r.kept for r in rows) == 3 and len(rows) == 7
    assert {(r.keep_id, r.group_size) for r in rows} == {(None, 4), (2, 2), (3, 1)}
    assert exact_dedup(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_golomb_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000):
        for top in (1, 2, 1 << 20, 1 << 47):
            values = np.sort(rng.integers(5, 5 + top, n))
            coded = golomb_encode(values, 5)
            assert (golomb_decode(coded, 5) == values).all()
    assert len(golomb_encode(np.sort(rng.integers(0, 1 << 48, 200_000)), 0)) < 200_000 * 4.2


def test_owners_follow_the_rows(spark, monkeypatch):
    import prosemill.llm.exact_dedup as M

    docs = [(i, f"text {i % 700}") for i in range(1000)] + [(5000 + i, "hot  text") for i in range(900)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = sorted(map(tuple, M.exact_dedup(df).collect()))
    seen, plain = [], M._answers
    monkeypatch.setattr(M, "_OWN", 50)
    monkeypatch.setattr(M, "_answers", lambda owners: seen.append(owners) or plain(owners))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        assert sorted(map(tuple, M.exact_dedup(df).collect())) == want and seen == [1900 // 50 + 1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
