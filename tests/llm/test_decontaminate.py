import random

import pytest
from pyspark.sql import functions as F

from prosemill.llm.decontaminate import decontaminate, find_leaks, op5_template_decontamination, tokens_of
from tests.conftest import plan_of

ITEM = "A train leaves Boston at 9 and travels 60 km before Alice boards it, how many hours until it reaches Denver if Alice sleeps 60 minutes?"
DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def leaks(spark, texts, items, **kinds):
    df = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(3)
    df = df.withColumn("start", F.lit(1)).withColumn("item", F.lit(2)).withColumn("tokens", F.lit(2))
    rows = find_leaks(df, spark.createDataFrame(items, ITEMS)).collect()
    assert len(rows) == len(texts)
    return {r.doc_id: [(x.item_id, x.exact) for x in r.leaks] for r in rows if r.leaks}


def test_reparameterised_questions_are_found_and_inconsistent_ones_are_not(spark):
    other = ITEM.replace("60", "75").replace("Alice", "Bob").replace("9", "11").replace("Boston", "Lyon")
    mixed = ITEM.replace("Alice sleeps", "Carol sleeps")
    texts = [ITEM, "Some words first. " + other + " And more after it.", mixed, ITEM.lower().upper(), ITEM.replace("travels", "goes"),
             "A train leaves. It travels far before somebody boards it.", "", None, "1 2 3 4 5 6 7 8 9 " * 50]
    got = leaks(spark, texts, [(7, ITEM)])
    assert got[0] == [(7, True)] and got[1] == [(7, False)]
    assert 2 not in got and not set(got) & {5, 6, 7, 8}
    assert got[4] == [(7, True)] and got[3] == [(7, True)]


def test_names_in_any_case(spark):
    shout = ITEM.replace("60", "75").replace("9", "11").upper()
    one = ITEM.replace("Boston", "boston")
    texts = [ITEM.upper(), ITEM.lower(), "so. " + shout + " AND MORE", one, ITEM.title(), ITEM.upper().replace("ALICE SLEEPS 60", "ALICE SLEEPS 61")]
    got = leaks(spark, texts, [(7, ITEM)])
    assert got[0] == got[1] == [(7, True)] and got[2] == [(7, False)] and got[3] == [(7, True)]
    assert 5 not in got  # the two numbers that are one in the item differ


def test_windows_through_a_shuffle_find_the_same(spark, monkeypatch):
    import prosemill.llm.decontaminate as M

    texts = [ITEM, ITEM.upper(), "nothing here at all, of any kind", ITEM.replace("60", "75").replace("Alice", "Bob"), ITEM.replace("Alice sleeps", "Carol sleeps")]
    want = leaks(spark, texts, [(7, ITEM), (8, "one two three four five")])
    monkeypatch.setattr(M, "BROADCAST_WINDOWS", 0)
    assert leaks(spark, texts, [(7, ITEM), (8, "one two three four five")]) == want and set(want) == {0, 1, 3}


def test_a_column_of_that_name(spark):
    df = spark.createDataFrame([(1, ITEM, 5), (2, "clean", 6)], "doc_id bigint, text string, leaks int")
    items = spark.createDataFrame([("a", ITEM)], "item_id string, text string")
    assert [tuple(r) for r in decontaminate(df, items).collect()] == [(2, "clean", 6)]
    assert {r.doc_id: r.found and r.found[0].item_id for r in find_leaks(df, items, leaks_col="found").collect()} == {1: "a", 2: None}
    assert find_leaks(df, items.limit(0), leaks_col="found").dtypes == find_leaks(df, items, leaks_col="found").dtypes
    with pytest.raises(ValueError, match="leaks"):
        find_leaks(df, items)


def test_short_items_shared_windows_and_repeats(spark):
    items = [(1, "one two three four five"), (2, "alpha beta"), (3, None), (4, ""), (5, ITEM), (6, ITEM), (None, "nine words that have no id but still say much")]
    texts = ["zero one two three four five six", "alpha beta", ITEM, ITEM, "nine words that have no id but still say much", "x " * 100_000 + ITEM]
    got = leaks(spark, texts, items)
    assert got[0] == [(1, True)] and 1 not in got
    assert got[2] == got[3] == got[5] == [(5, True), (6, True)] and got[4] == [(None, True)]


def test_rows_of_one_id_and_null_ids(spark):
    df = spark.createDataFrame([(1, ITEM), (1, "clean"), (1, ITEM), (None, ITEM), (None, "clean")], DOCS)
    items = spark.createDataFrame([(7, ITEM)], ITEMS)
    assert sorted((r.doc_id or 0, r.text) for r in decontaminate(df, items).collect()) == [(0, "clean"), (1, "clean")]
    assert decontaminate(df, items).columns == df.columns
    assert decontaminate(df, items.limit(0)).count() == 5 and decontaminate(df.limit(0), items).count() == 0


def test_tokens(apply):
    mark = {"": "#", "": "u", "": "N"}
    got = apply(tokens_of, ["It took 3.5 km to Rome, then 12:30 and x9 5% of A"], )
    assert ["".join(mark.get(c, c) for c in t) for t in got[0]] == ["it", "took", "#3.5", "ukm", "to", "Nrome", "then", "#12:30", "and", "x9", "#5", "of", "Na"]


def test_exact_passages_equal_brute_force(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("bcdfgaeiou") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(rng.randint(15, 40)))) for i in range(10)]
    texts, want = [], {}
    for i in range(120):
        words = [word() for _ in range(rng.randint(5, 300))]
        for k, t in rng.sample(items, rng.choice((0, 0, 1, 2))):
            at = rng.randint(0, len(words))
            words[at:at] = [f" {t} "]
            want.setdefault(i, []).append(k)
        texts.append(" ".join(words))
    found = leaks(spark, texts, items)
    brute = {i: sorted((k, True) for k, t in items if t in text) for i, text in enumerate(texts)}
    assert {i: v for i, v in found.items()} == {i: v for i, v in brute.items() if v}


def test_query_finds_every_whole_item_without_python(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    want = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text}
    out = op5_template_decontamination(spark, sf)
    assert "Python" not in plan_of(out)
    got = {(r.doc_id, r.item_id) for r in out.collect()}
    assert want <= got and len({d for d, _ in got} - {d for d, _ in want}) <= 0.02 * len(docs)
