import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from prosemill.llm.components import components
from prosemill.llm.ngram_join import keep_one, ngram_join, op1_ngram_jaccard_join
from prosemill.llm.shingles import shingle_sets, word_hashes

from .brute import ngram_groups, roots, word_shingles

SCHEMA = "doc_id bigint, text string"


def grouped(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def family(rng, base, copies, edits):
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"new{rng.random()}"
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def near(spark):
    rng = random.Random(5)
    texts = []
    for k in range(12):
        base = [f"w{k}_{rng.randrange(400)}" for _ in range(rng.choice((6, 40, 150, 300)))]
        texts += family(rng, base, rng.choice((2, 5, 30)), max(1, len(base) // 40))
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"u{k}_{i}" for i in range(200)) for k in range(40)]
    texts += ["", None, " \t\n", "One two", "one  TWO", "one two three", "a b c d e", "A b c d e f"] + texts[:20]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_groups_equal_brute_force(spark, near):
    out, _ = ngram_join(spark.createDataFrame(near, SCHEMA).repartition(5))
    assert grouped(out) == ngram_groups(near)


def test_no_link_hides_behind_a_hub(spark):
    # a chain in which most sets are not similar to the hub
    words = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join(words[7 * i:7 * i + 130])) for i in range(35)]
    out, links = ngram_join(spark.createDataFrame(docs, SCHEMA))
    assert grouped(out) == ngram_groups(docs)
    assert len({c for _, c in grouped(out).values()}) == 1 and links.count() >= 34


def test_large_family_makes_few_pairs(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(200)]
    docs = list(enumerate(family(rng, base, 300, 2)))
    out, links = ngram_join(spark.createDataFrame(docs, SCHEMA))
    assert grouped(out) == ngram_groups(docs)
    assert links.count() < 3 * len(docs)


def test_null_ids_repeats_extra_columns_and_empty_tables(spark):
    docs = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, None), (None, None)]
    df = spark.createDataFrame(docs, SCHEMA).withColumn("n", F.lit(1)).withColumn("part", F.lit(2)).withColumn("component_id", F.lit(0))
    got = sorted(map(tuple, ngram_join(df)[0].drop("h", "root").collect()), key=repr)
    assert got == sorted([(None, 2, 3), (3, 2, 3), (3, 2, 3), (4, 0, 4), (None, 0, None)], key=repr)
    assert ngram_join(spark.createDataFrame([], SCHEMA))[0].count() == 0
    with pytest.raises(ValueError):
        ngram_join(df, percent=70)


def test_very_long_text(spark):
    text = " ".join(f"w{i}" for i in range(200_000))
    docs = [(1, text), (2, text + " end"), (3, "x" * 500_000)]
    assert {k: v[1] for k, v in grouped(ngram_join(spark.createDataFrame(docs, SCHEMA))[0]).items()} == {1: 1, 2: 1, 3: 3}


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert grouped(op1_ngram_jaccard_join(spark, sf)) == ngram_groups(docs)


def test_shingles_do_not_depend_on_blocks():
    texts = ["The  quick\tbrown fox jumps Over", "", None, "ß é ñ", "one", "a b c d e a b c d e", "x y z " * 50]
    whole = {r: g.tolist() for r, g in shingle_sets(pa.array(texts))}
    assert whole == {r: g.tolist() for r, g in shingle_sets(pa.array(texts), size=1)}
    assert [len(whole[i]) for i in range(len(texts))] == [len(word_shingles(t)) for t in texts]
    words, counts = word_hashes(np.array([0, 3, 6]), np.frombuffer(b"ab ABx", np.uint8))
    assert counts.tolist() == [1, 1] and words[0] != words[1]


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    real = [(a, b) for a, b in edges if a != b]
    want = roots({x for e in real for x in e}, real)
    assert {r.node: r.root for r in components(df, "a", "b").collect()} == want
    assert components(df.limit(0), "a", "b").count() == 0


def test_keep_one_row_of_each_component(spark, near):
    df = spark.createDataFrame(near, SCHEMA).withColumn("n", F.lit(1)).withColumn("h", F.lit(1)).withColumn("copies", F.lit(1))
    out = keep_one(df)
    want = ngram_groups(near)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, (n, c) in want.items() if i == c or not n)
    odd = [(None, "a b c"), (None, "a b c"), (3, "a b c"), (3, "a b c"), (3, "x y z"), (4, None), (4, None), (None, "q r"), (None, "q r")]
    kept = sorted(map(tuple, keep_one(spark.createDataFrame(odd, SCHEMA)).collect()), key=repr)
    assert kept == sorted([(3, "a b c"), (3, "x y z"), (4, None), (4, None), (None, "q r")], key=repr)


def test_groups_follow_the_data(spark, monkeypatch):
    import random

    import prosemill.llm.ngram_join as M

    rng = random.Random(11)
    base = [[f"w{rng.randrange(900)}" for _ in range(60)] for _ in range(5)]
    docs = [(i, " ".join(w if rng.random() > 0.02 else "x" + w for w in rng.choice(base))) for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = ngram_groups(docs)
    cut, plain, sizes = [], M._slices, []
    monkeypatch.setattr(M, "_FRAGMENT_CHARS", 500)
    monkeypatch.setattr(M, "_PART_SHINGLES", 50)
    monkeypatch.setattr(M, "_slices", lambda parts, width: cut.append(parts) or plain(parts, width))
    monkeypatch.setattr(M, "_map_side", lambda fragments, width, plain=M._map_side: sizes.append(fragments) or plain(fragments, width))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        rows = M.ngram_join(df)[0].collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert sizes == [sum(len(t) for _, t in docs) // 500 + 1] and cut[0] > 60
