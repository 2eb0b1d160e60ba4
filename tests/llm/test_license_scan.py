import re

from pyspark.sql import functions as F

from prosemill.llm.license_scan import BASE, OWN, op10_license_scan, scan_licenses
from tests.conftest import plan_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    """(n_words, n_base, first, last, base labels) of one text."""
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, at, labels = WORD.findall(lower), [], set()
    for t in BASE:
        phrase = t.text.split()
        for i in range(len(words)):
            if words[i:i + len(phrase)] == phrase:
                at.append(i)
                labels.add(t.label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


CASES = [
    ("Licensed under the MIT License.", "mit"), ("UNDER (the)\nMIT-license; under the mit license", "mit"),
    ("under the mit licenses", ""), ("thunder the mit license", ""), ("under the MIT", ""), ("under the éMIT license", ""),
    ("Apache License, Version 2.0 and CC BY-NC 4.0", "apache-2,cc-by-nc"), ("apache license version 20", ""), ("cc by nc cc by nc", "cc-by-nc"),
    ("licensed under the GNU General Public License, version 3", "gpl"), ("the GNU General Public License v3", "gpl"),
    ("GNU general licence", ""), ("licensed under GNU Lesser General Public License version 2", "lgpl"),
    ("Permission is hereby granted, free of charge, to any human obtaining a copy of this software", "mit"),
    ("Redistribution and use in source and binary forms, with or without changes, are permitted", "bsd"),
    ("All rights reserved.", "all-rights-reserved"), ("rights reserved", ""),
    ("", ""), (None, ""), ("   ", ""), ("x " * 100_000 + "under the mit license", "mit"), ("license " * 3000, ""),
]


def test_cases(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id bigint, text string").repartition(3)
    rows = scan_licenses(df.withColumn("words", F.lit(1)).withColumn("places", F.lit(2)).withColumn("key", F.lit(2))).collect()
    assert len(rows) == len(CASES)
    for r in rows:
        text, labels = CASES[r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text), text
        assert set(r.labels.split(",")) >= set(r.base_labels.split(",")) - {""}
        assert r.labels == labels, text
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels) and (not r.base_labels or r.score == 1)


def test_null_and_repeated_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "cc by nc"), (1, "a"), (1, "a")], "doc_id bigint, text string")
    assert sorted((r.doc_id or 0, r.n_base) for r in scan_licenses(df).collect()) == [(0, 1), (1, 0), (1, 0)]
    assert scan_licenses(df.limit(0)).count() == 0


def test_templates_hold_their_phrase():
    for t in BASE + OWN:
        assert t.must in t.text and t.text == " ".join(WORD.findall(t.text))


def test_query_equals_brute_force_without_python(spark):
    sf = "/root/testdata/sf0.001"
    texts = dict(map(tuple, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()))
    out = op10_license_scan(spark, sf)
    rows = out.collect()
    assert len(rows) == len(texts) and "Python" not in plan_of(out) and "Exchange hash" not in plan_of(out)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
