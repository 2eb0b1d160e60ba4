import random

import pytest
from pyspark.sql import functions as F

from prosemill.operators import sketches as K
from prosemill.operators.report import uniqueness_check

SHARES = (0.01, 0.25, 0.5, 0.75, 0.99)


def off(values, answer, share):
    """How far the rank of an answer is from the share asked for."""
    under, upto = (sum(f(v) for v in values) / len(values) for f in (lambda v: v < answer, lambda v: v <= answer))
    return max(under - share, share - upto, 0)


@pytest.fixture(scope="module")
def values():
    rng = random.Random(4)
    return [rng.choice((rng.gauss(100, 30), rng.expovariate(0.01), float(rng.randrange(20)))) for _ in range(30_000)]


def test_quantiles_keep_to_their_bound_also_merged(spark, values, tmp_path):
    df = spark.createDataFrame([("input" if i % 3 else "output", i, v) for i, v in enumerate(values)], "side string, i bigint, v double").repartition(7)
    measures, k = {"v": F.col("v"), "i": F.col("i")}, 200
    whole = K.quantile_report(K.quantile_sketches(df, measures, k=k), SHARES, k=k).collect()
    for run in range(4):
        K.keep_sketches(K.quantile_sketches(df.where(F.col("i") % 4 == run), measures, k=k), str(tmp_path), f"r{run}")
    K.keep_sketches(K.quantile_sketches(df.where("i % 4 = 2"), measures, k=k), str(tmp_path), "r2")  # replaced, not added
    merged = K.quantile_report(K.merge_quantiles(K.kept_sketches(spark, str(tmp_path))), SHARES, k=k).collect()
    assert len(whole) == len(merged) == 4
    bound = 1.5 * K.rank_error(k)  # 99 % each; thirty answers are looked at
    for rows in (whole, merged):
        for r in rows:
            own = [(v if r.measure == "v" else i) for i, v in enumerate(values) if ("input" if i % 3 else "output") == r.side]
            assert (r.docs, r.n, r.least, r.most) == (len(own), len(own), min(own), max(own)) and r["mean"] == pytest.approx(sum(own) / len(own))
            assert all(off(own, r[f"p{round(100 * p)}"], p) <= bound for p in SHARES) and r.rank_error == K.rank_error(k)


def test_sketches_do_not_grow_with_their_input(spark):
    sizes = [K.quantile_sketches(spark.range(n).withColumn("side", F.lit("x")), {"id": F.col("id")}).select(F.length("sketch")).first()[0] for n in (10_000, 1_000_000)]
    assert sizes[1] < 1.3 * sizes[0] < 40_000


def test_missing_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("b", None)], "side string, v double")
    rows = {r.side: r for r in K.quantile_report(K.quantile_sketches(df, {"v": F.col("v")})).collect()}
    assert (rows["a"].docs, rows["a"].n, rows["a"].p50) == (3, 1, 1.0) and (rows["b"].docs, rows["b"].n, rows["b"].p50, rows["b"]["mean"]) == (1, 0, None, None)
    assert K.quantile_sketches(df.limit(0), {"v": F.col("v")}).count() == 0
    with pytest.raises(ValueError, match="name a run"):
        K.keep_sketches(df, "x", "a/b")


def test_distinct_counts_and_what_sides_share(spark):
    n, lg = 40_000, 10
    df = spark.range(n).select(F.when(F.col("id") < n // 2, "a").otherwise("b").alias("side"), F.col("id").alias("doc_id"),
                               F.concat(F.lit("t"), F.col("id") % 15_000).alias("text"))
    parts = [K.uniqueness_sketches(df.where(F.col("doc_id") % 2 == k), lg=lg) for k in (0, 1)]
    merged = K.merge_uniqueness(parts[0].unionByName(parts[1]), lg=lg)
    exact = {r.side: r for r in uniqueness_check(df).collect()}
    for r in K.uniqueness_report(merged, lg=lg).collect():
        assert r.docs == exact[r.side].docs and r.error_pct == pytest.approx(300 / 32, abs=1e-4)
        for c in ("unique_ids", "unique_texts"):
            assert abs(r[c] - exact[r.side][c]) <= exact[r.side][c] * r.error_pct / 100 and r[c] <= r.docs
    shared = K.shared_report(merged, "a", "b").first()
    assert shared.shared_ids == 0 and abs(shared.shared_texts - 15_000) < 0.2 * 15_000 and shared.only_first < 1500
    alone = K.shared_report(merged.where("side = 'a'"), "a", "b").first()
    assert (alone.shared_ids, alone.shared_texts) == (0, 0)


def test_small_counts_are_exact_and_nulls_are_no_values(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", 2, None), ("b", None, "y")], "side string, doc_id bigint, text string")
    got = {r.side: r for r in uniqueness_check(df, approximate=True).collect()}
    want = {r.side: r for r in uniqueness_check(df).collect()}
    assert all(got[s][c] == want[s][c] for s in want for c in want[s].asDict())
