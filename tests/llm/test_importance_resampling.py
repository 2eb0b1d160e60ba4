import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from prosemill.llm import importance_resampling as M

DOCS = "doc_id bigint, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = str.maketrans(M.UPPER, M.LOWER)


def runs(text):
    words = WORD.findall((text or "").translate(SMALL))
    return len(words), [" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def bucket(run, n):
    return zlib.crc32(run.encode()) % n


def brute(docs, target, percent=5, least=20, n=M.BUCKETS):
    """Sorted (id, features, weight, score, rank) with ids that are distinct."""
    s, t = (Counter(bucket(x, n) for _, text in rows for x in runs(text)[1]) for rows in (docs, target))
    ss, tt = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (ss + n) / ((s[b] + 1) * (tt + n)))) for b in range(n)}
    out = []
    for i, text in docs:
        words, own = runs(text)
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(x, n)] for x in own)
        out.append((i, words, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    may = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0]))
    rank = {x[0]: k for k, x in enumerate(may[:len(may) * percent // 100], 1)}
    return sorted((i, f, w, s, rank.get(i)) for i, _, f, w, s in out)


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß日Z9") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    return [(i, rng.choice(" .\n").join(rng.choice(words) + rng.choice(("", ",", "-x", "  ")) for _ in range(rng.randint(0, 60)))) for i in range(n)]


def test_crc_of_concatenations():
    rng = random.Random(2)
    a, b = ([rng.randbytes(rng.choice((0, 1, 7, 64, 3000, 70_000))) for _ in range(200)] for _ in "ab")
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    assert M.appended(crc(a), crc(b), np.array([len(x) for x in b])).tolist() == [zlib.crc32(x + y) for x, y in zip(a, b)]


def test_scan_does_not_depend_on_the_dictionary():
    texts = [(t or "").encode() for _, t in corpus(60)] + [b"", b"!", "É".encode() * 3]
    vocabulary = sorted({w for t in texts for w in WORD.findall(t.decode().translate(SMALL))})
    for words in ((), tuple(vocabulary[::3]), tuple(vocabulary)):
        counts, found = M.scan(texts, words)
        got = Counter((int(d), int(c)) for doc, crc in found for d, c in zip(doc, crc))
        assert counts.tolist() == [runs(t.decode())[0] for t in texts]
        assert got == Counter((i, zlib.crc32(x.encode())) for i, t in enumerate(texts) for x in runs(t.decode())[1])


def test_against_brute_force(spark):
    docs, target = corpus(400), corpus(30, 9)
    out = M.importance_resample(spark.createDataFrame(docs, DOCS).repartition(7), spark.createDataFrame(target, DOCS),
                                percent=20, dictionary=100)
    assert out.dtypes == [("doc_id", "bigint"), *((c, "bigint") for c in ("n_features", "weight", "score", "rank"))]
    assert sorted(map(tuple, out.collect()), key=lambda r: r[0]) == brute(docs, target, 20)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = [(None, text), (1, None), (2, ""), (3, "... !"), (4, text), (4, text), (5, "x" * 300_000), (6, "y " * 200_000), (7, "ÀÉ é z"), (None, None)]
    df = spark.createDataFrame(docs, DOCS).withColumn("weight", F.lit("?")).withColumn("id", F.lit(1)).withColumn("n", F.lit(1))
    out = M.importance_resample(df, spark.createDataFrame([(1, text), (2, None)], DOCS), percent=100, buckets=50).collect()
    assert len(out) == len(docs)
    by = {r.doc_id: r for r in out}
    assert [by[i].n_features for i in (1, 2, 3, 4, 5, 7)] == [0, 0, 0, 87, 1, 3] and by[6].n_features == 599_997
    assert by[1].weight == by[3].weight == 0
    ranks = sorted((r for r in out if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranks] == [1, 2, 3, 4] and [r.score for r in ranks] == sorted((r.score for r in ranks), reverse=True)
    assert sum(r.doc_id == 4 for r in ranks) == 2 and all(r.n_features >= 57 for r in ranks)


def test_empty_tables(spark):
    docs = spark.createDataFrame(corpus(50), DOCS)
    none = docs.limit(0)
    assert M.importance_resample(none, docs).count() == 0
    got = M.importance_resample(docs, none)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == brute(corpus(50), [])


def test_result_does_not_depend_on_partitions(spark):
    docs, target = corpus(300, 4), spark.createDataFrame(corpus(20, 5), DOCS)
    results = [M.importance_resample(spark.createDataFrame(docs, DOCS).repartition(n), target).collect() for n in (1, 9)]
    once, again = (sorted(map(str, rows)) for rows in results)
    assert once == again
