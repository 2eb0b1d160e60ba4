import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from prosemill.llm.vector_codes import Codebooks, compress_vectors, fit_codebooks, nearest

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, parts=4, entries=256, rounds=4):
    """{id: (code, error, label error)} and the digest, for rows with distinct ids."""
    kept = [(i, [math.floor(1024 * x) for x in v], k) for i, v, k in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    w = len(kept[0][1]) // parts
    cut = {i: [v[p * w:(p + 1) * w] for p in range(parts)] for i, v, _ in kept}
    books = [[cut[i][p] for i in sorted(cut)[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for turn in range(rounds + 1):
        near = {i: [min(range(len(b)), key=lambda e: (far(x, b[e]), e)) for x, b in zip(own, books)] for i, own in cut.items()}
        if turn < rounds:
            for p in range(parts):
                for e in range(len(books[p])):
                    own = [cut[i][p] for i in cut if near[i][p] == e]
                    if own:
                        books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    error = {i: sum(far(cut[i][p], books[p][e]) for p, e in enumerate(near[i])) for i in cut}
    label = {i: k for i, _, k in kept}
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return {i: ("".join(f"{e:02x}" for e in near[i]), error[i], sum(error[j] for j in cut if label[j] == label[i])) for i in cut}, digest


def vectors(n, d=8, seed=1, step=None):
    rng = random.Random(seed)
    one = (lambda: rng.gauss(0, 0.3)) if step is None else (lambda: rng.randint(-2, 2) * step)
    return [(i, np.array([one() for _ in range(d)], np.float32).tolist(), rng.choice((None, 1, 2, 7))) for i in rng.sample(range(10 * n), n)]


def test_nearest_equals_the_plain_search():
    rng = np.random.default_rng(1)
    for k, width, most in ((256, 16, 500), (1, 3, 2), (40, 2, 3), (100, 1, 1000), (30, 2, 2**29)):
        book, x = rng.integers(-most, most, (k, width)), rng.integers(-most, most, (700, width))
        found, best, computed = nearest(x, book)
        far = ((x[:, None] - book[None]) ** 2).sum(2)
        assert (far.argmin(1) == found).all() and (far.min(1) == best).all() and computed <= far.size
    # sums tell the entries apart, so few of them are looked at
    line = np.sort(rng.integers(-10**6, 10**6, (256, 1)), 0)
    assert nearest(rng.integers(-10**6, 10**6, (5000, 1)), line)[2] < 0.3 * 256 * 5000


@pytest.mark.parametrize("step", [None, 0.5])
def test_against_brute_force(spark, step):
    rows = vectors(500, step=step)
    out = compress_vectors(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    want, digest = brute(rows)
    assert {r.vec_id: (r.code, r.error, r.label_error) for r in out} == want
    assert {r.codebooks_sha256 for r in out} == {digest} and len(out) == len(rows)


def test_rows_that_cannot_be_coded(spark):
    rows = vectors(60)
    bad = [(1001, None, 1), (1002, [float("nan")] * 8, 1), (1003, [0.0] * 7 + [None], 1), (1004, [float("-inf")] * 8, None), (1005, [], 2), (1006, [1.0] * 4, 2)]
    df = spark.createDataFrame(rows + bad, SCHEMA).withColumn("code", F.lit(1)).withColumn("v", F.lit(1)).withColumn("key", F.lit(1))
    want, digest = brute(rows)
    out = compress_vectors(df).collect()
    assert {r.vec_id: (r.code, r.error, r.label_error) for r in out} == want and out[0].codebooks_sha256 == digest
    assert compress_vectors(df.limit(0)).count() == 0 and compress_vectors(df.where("vec_id > 1000 AND vec_id < 1006")).count() == 0


def test_repeated_and_null_ids_and_lengths(spark):
    rows = [(1, [0.1, 0.2, 0.3, 0.4, 0.5], 3)] * 3 + [(None, [0.9] * 5, None)] * 2 + [(2, [0.1, 0.2, 0.3, 0.4, 0.6], None)]
    out = compress_vectors(spark.createDataFrame(rows, SCHEMA), entries=2).collect()
    assert sorted((str(r.vec_id), len(r.code)) for r in out) == sorted((str(i), 8) for i, _, _ in rows)
    assert len({r.code for r in out if r.vec_id == 1}) == 1
    assert {r.label_error for r in out if r.vec_id != 1} == {sum(r.error for r in out if r.vec_id != 1)}


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="64 bits"):
        compress_vectors(spark.createDataFrame([(1, [3e38] * 8, 1), (2, [-3e38] * 8, 1)], SCHEMA)).collect()


def test_codes_decode(spark):
    rows = vectors(40, d=6)
    df = spark.createDataFrame(rows, SCHEMA)
    books = fit_codebooks(df)
    assert isinstance(books, Codebooks) and books.length == 6
    out = compress_vectors(df).select("vec_id", books.vector(F.col("code")).alias("v")).collect()
    by = {i: v for i, v, _ in rows}
    # as many entries as vectors: only the floor is lost
    assert all(0 <= x - y < 2 / 1024 for r in out for x, y in zip(by[r.vec_id], r.v)) and all(len(r.v) == 6 for r in out)
