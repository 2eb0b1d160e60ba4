import random

import pytest
from pyspark.sql import functions as F

from prosemill.llm import substring_dedup as M
from prosemill.llm.substring_dedup import LEAST_WORDS, op2_substring_dedup, repeated_passages, substring_dedup, units

DOCS = "doc_id bigint, text string"


def brute(docs, least=LEAST_WORDS, unit_of="sentence"):
    """{(doc, start, end)} of removed passages; ids are distinct."""
    seen, out = set(), set()
    for i, text in sorted((d for d in docs if d[1]), key=lambda d: (d[0] is None, d[0])):
        run = []
        for unit in [*units(text, unit_of), None]:
            if unit and unit[2] in seen:
                run.append(unit)
                continue
            if sum(u[2].count(" ") + 1 for u in run) >= least:
                out.add((i, run[0][0], run[-1][1]))
            run = []
            if unit:
                seen.add(unit[2])
    return out


def corpus(n=200, seed=1):
    rng = random.Random(seed)
    sentence = lambda: " ".join(rng.choice("abcdefghijklmnopqrstuvw") * rng.randint(1, 4) for _ in range(rng.randint(1, 14))) + rng.choice(".!?")
    passages = [" ".join(sentence() for _ in range(rng.randint(3, 9))) for _ in range(12)]
    docs = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.3 else sentence() for _ in range(rng.randint(1, 20))]
        docs.append((i, "".join(p + rng.choice((" ", "  ", "\n", "\n\n")) for p in parts)))
    return docs


def test_equals_brute_force(spark):
    docs = corpus() + [(1000, ""), (1001, None), (1002, " \n "), (None, corpus()[0][1])]
    df = spark.createDataFrame(docs, DOCS).repartition(7).withColumn("start", F.lit(1)).withColumn("h", F.lit(1)).withColumn("print", F.lit(1))
    for unit, least in (("sentence", LEAST_WORDS), ("line", 1)):
        got = {(r.id, r.start, r.end) for r in repeated_passages(df, unit=unit).collect()}
        assert got == brute(docs, least, unit) and len(got) > 50


def test_every_repeated_line_goes(spark):
    docs = [(1, "First of all\n  Read   more \nok\n"), (2, "Another line\nread more\n\nOK"), (3, "Read more")]
    df = spark.createDataFrame(docs, DOCS)
    rows = {r.doc_id: (r.text, r.gone and [tuple(x) for x in r.gone]) for r in substring_dedup(df.withColumn("removed", F.lit(7)), removed_col="gone").collect()}
    assert rows == {1: (docs[0][1], None), 2: ("Another line\n", [(13, 26)]), 3: ("", [(0, 9)])}
    got = [(r.id, r.start, r.units, r.keep_id, r.keep_start) for r in repeated_passages(df).orderBy("id").collect()]
    assert got == [(2, 13, 2, 1, 15), (3, 0, 1, 1, 15)]
    with pytest.raises(ValueError, match="removed"):
        substring_dedup(df.withColumn("removed", F.lit(7)))
    with pytest.raises(ValueError, match="unit"):
        repeated_passages(df, unit="word")


def test_groups_follow_the_data_and_hot_units_are_spread(spark, monkeypatch):
    docs = [(i, f"the same line\nline {i}\nthe same line") for i in range(400)]
    df = spark.createDataFrame(docs, DOCS)
    monkeypatch.setattr(M, "_FRAGMENT_CHARS", 100)
    seen, plain = [], M._prints
    monkeypatch.setattr(M, "_prints", lambda fragments, unit: seen.append(fragments) or plain(fragments, unit))
    got = {(r.id, r.start) for r in repeated_passages(df).collect()}
    assert seen == [sum(len(t) for _, t in docs) // 100 + 1]
    assert got == {(0, docs[0][1].rindex("the"))} | {x for i, t in docs[1:] for x in ((i, 0), (i, t.rindex("the")))}


def test_texts_without_the_passages(spark):
    text = "One sentence that is only here. " + " ".join(f"word{i}" for i in range(60)) + ". Tail é of it."
    docs = [(1, text), (2, "Start. " + text.upper() + " End."), (3, "x"), (4, None), (5, "")]
    df = spark.createDataFrame(docs, DOCS).withColumn("n", F.lit(1))
    rows = {r.doc_id: r for r in substring_dedup(df, unit="sentence").collect()}
    assert rows[1].text == text and rows[1].removed is None
    assert rows[2].text == "Start.  End." and [tuple(x) for x in rows[2].removed] == [(7, 7 + len(text))]
    assert rows[3].text == "x" and rows[4].text is None and rows[5].text == "" and set(df.columns) < set(rows[1].asDict())


def test_common_short_sentences_stay(spark):
    docs = [(i, f"Only doc {i} says this. Read more. All rights reserved. And {i} too.") for i in range(30)]
    assert repeated_passages(spark.createDataFrame(docs, DOCS), unit="sentence").count() == 0


def test_repeats_inside_a_text_repeated_rows_and_empty_table(spark):
    passage = " ".join(f"w{i}" for i in range(30)) + "."
    df = spark.createDataFrame([(1, f"{passage} {passage} {passage}")] * 2 + [(2, passage)], DOCS)
    got = sorted((r.id, r.start, r.end, r.keep_id, r.keep_start) for r in repeated_passages(df, unit="sentence").collect())
    n = len(passage)
    assert got == [(1, n + 1, 3 * n + 2, 1, 0), (2, 0, n, 1, 0)]
    assert repeated_passages(df.limit(0)).count() == 0


def test_very_long_text(spark):
    text = "a b c " * 200_000 + "."
    got = repeated_passages(spark.createDataFrame([(1, text), (2, "x. " + text)], DOCS), unit="sentence").collect()
    assert [(r.id, r.start, r.end) for r in got] == [(2, 3, 3 + len(text))]


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert {(r.doc_id, r.start, r.end) for r in op2_substring_dedup(spark, sf).collect()} == brute(docs)
