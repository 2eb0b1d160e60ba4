"""Near duplicates whose bucket hits are verified by the similarity of shingle sets."""

import random

import pytest
from pyspark.sql import functions as F

from prosemill.operators import dedup as D
from prosemill.operators.joins import join_spread
from prosemill.plans import config as C
from tests.conftest import plan_of


def jaccard(x, y):
    return len(x & y) / (len(x) + len(y) - len(x & y))


def sequential(members, sets, threshold):
    """Documents dropped by a walk in order that compares with every kept one of a common bucket."""
    held, gone = {}, set()
    of = {}
    for doc, bucket in members:
        of.setdefault(doc, set()).add(bucket)
    for doc in sorted(of):
        near = {k for b in of[doc] for k in held.get(b, ())}
        if any(jaccard(sets[k], sets[doc]) >= threshold for k in near):
            gone.add(doc)
        else:
            for b in of[doc]:
                held.setdefault(b, []).append(doc)
    return gone


def dropped(spark, members, sets, threshold, parts=5):
    table = spark.createDataFrame(members, "doc bigint, bucket string").repartition(parts)
    both = spark.createDataFrame([(d, sorted(s)) for d, s in sets.items()], "doc bigint, hashes array<bigint>")
    rows = D.first_verified_wins(table, both, threshold).collect()
    assert len(rows) == len({r.doc for r in rows})
    return {r.doc for r in rows}


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_sequential_walk(spark, seed):
    rng = random.Random(seed)
    docs, buckets = rng.choice((12, 40)), rng.choice((3, 10, 25))
    bases = [set(rng.sample(range(100), 10)) for _ in range(rng.choice((2, 6)))]
    sets = {d: set(rng.choice(bases)) ^ set(rng.sample(range(100), rng.randint(0, 3))) for d in range(docs)}
    members = sorted({(d, f"b{rng.randrange(buckets)}") for d in range(docs) for _ in range(rng.randint(1, 4))})
    assert dropped(spark, members, sets, 0.6) == sequential(members, sets, 0.6)


def test_a_bucket_may_keep_several(spark):
    sets = {d: set(range(10 * (d % 3), 10 * (d % 3) + 10)) for d in range(30)}
    members = [(d, "one") for d in range(30)]
    assert dropped(spark, members, sets, 0.8) == set(range(3, 30))


def test_a_dropped_document_drops_nothing(spark):
    sets = {0: {1, 2, 3, 4}, 1: {2, 3, 4, 5}, 2: {3, 4, 5, 6}, 3: {9}}
    members = [(0, "x"), (1, "x"), (1, "y"), (2, "y"), (2, "x"), (3, "y"), (3, "x")]
    assert dropped(spark, members, sets, 0.6) == {1} == sequential(members, sets, 0.6)


def test_large_group_of_copies_is_one_pair_each(spark, monkeypatch):
    formed, plain = [], D.with_jaccard

    def counting(pairs, sets):
        formed.append(pairs.count())
        return plain(pairs, sets)

    monkeypatch.setattr(D, "with_jaccard", counting)
    sets = {d: set(range(20)) for d in range(600)}
    members = [(d, b) for d in range(600) for b in "ab"]
    assert dropped(spark, members, sets, 0.8) == set(range(1, 600)) and formed == [599]
    # documents that are not similar are compared with each kept one, in few rounds
    formed.clear()
    sets = {d: {d} for d in range(60)}
    assert dropped(spark, [(d, "a") for d in range(60)], sets, 0.8) == set() and sum(formed) <= 60 * 59 / 2 and len(formed) <= 7


def texts():
    rng = random.Random(3)
    base = [[f"w{rng.randrange(5000)}" for _ in range(60)] for _ in range(8)]
    rows = []
    for i in range(60):
        words = list(rng.choice(base))
        for _ in range(rng.choice((0, 1, 4, 9))):
            words[rng.randrange(60)] = f"x{rng.randrange(5000)}"
        rows.append((i, rng.randrange(3), " ".join(words)))
    return rows + [(100, 1, ""), (101, 2, None), (102, 0, "")]


CFG = D.DedupConfig(family="md5", threshold=0.7, num_perm=64, ngram_size=2, verify=True)


def test_verified_dedup_of_texts_in_an_order(spark):
    df = spark.createDataFrame(texts(), "doc_id bigint, prio bigint, text string")
    bands = {r.doc_id: r.buckets for r in D.band_table(df, ["prio"], CFG).collect()}
    place = {r[0]: k for k, r in enumerate(sorted(texts(), key=lambda r: (r[1], r[0])))}
    sets = {place[i]: {tuple(t.split()[k:k + 2]) for k in range(59)} for i, _, t in texts() if t}
    members = [(place[i], bytes(b)) for i in bands for b in bands[i]]
    gone = sequential(members, sets, 0.7)
    loose = sequential(members, sets, 0.0)
    assert gone < loose
    kept = D.dedup_fuzzy(df, ["prio"], CFG)
    assert kept.columns == df.columns
    assert {place[r.doc_id] for r in kept.collect()} == set(place.values()) - gone
    both = D.dedup(df.repartition(3), ["prio"], CFG)
    assert {place[r.doc_id] for r in both.collect()} == set(place.values()) - gone


def test_matches_carry_their_similarity(spark):
    df = spark.createDataFrame(texts(), "doc_id bigint, prio bigint, text string")
    sets = {i: {tuple(t.split()[k:k + 2]) for k in range(59)} for i, _, t in texts() if t}
    rows = D.near_dup_matches(df, ["doc_id"], CFG).collect()
    assert rows and len(rows) == len({r.doc for r in rows})
    assert all(r.kept_doc < r.doc and r.jaccard == pytest.approx(jaccard(sets[r.doc], sets[r.kept_doc])) for r in rows)
    none = D.near_dup_matches(df.where("doc_id > 99"), ["doc_id"], CFG)
    assert none.columns == ["doc", "kept_doc", "jaccard"] and none.count() == 0


def test_join_spread_equals_a_join(spark):
    left = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(900)], "k bigint, v bigint")
    right = spark.createDataFrame([(i, [i, -i]) for i in range(0, 900, 2)] + [(1, [7])], "k bigint, w array<bigint>")
    key = lambda r: (r.k, r.v, r.w)
    want = sorted(map(key, left.join(right, "k").collect()))
    for most in (10_000, 50, 1):
        assert sorted(map(key, join_spread(left, right, "k", most).select("k", "v", "w").collect())) == want
    assert "NestedLoop" not in plan_of(join_spread(left, right, "k"))


@pytest.mark.parametrize("slices", [2, 50, 5000])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_join_salted_equals_a_join(spark, monkeypatch, how, slices):
    import prosemill.operators.joins as J

    monkeypatch.setattr(J, "HOT_SLICES", slices)
    left = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(600)], "k bigint, v bigint")
    right = spark.createDataFrame([(i, -i) for i in range(0, 600, 2)] + [(1, 7)], "k bigint, w bigint")
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    got = J.join_salted(left, right, "k", counts, 600, how)
    want = left.join(right, "k", how)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_configuration(spark):
    cfg = C.from_dict({"ingestion": {"input_path": "x"}, "deduplication": {"verify": True}})
    assert cfg.deduplication.verify and not D.DedupConfig().verify
    df = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    assert D.dedup_fuzzy(df.limit(0), ["doc_id"], CFG).count() == 0 and D.dedup_fuzzy(df, ["doc_id"], CFG).count() == 1
    assert D.dedup_fuzzy(df.drop("text"), ["doc_id"], CFG).select(F.count("*")).first()[0] == 1
