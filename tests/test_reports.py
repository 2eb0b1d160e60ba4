import math
import random

import pytest
from pyspark.sql import functions as F

from prosemill.operators import perplexity as PP
from prosemill.operators import profile as R
from prosemill.operators import report as V
from prosemill.sources.jsonl import pair
from tests.conftest import plan_of

# ---------------------------------------------------------------------------- profile

LINES = [
    '{"id": 1, "text": "' + "x" * 150 + '", "tags": [1], "meta": {"a": 1}, "flag": true, "score": 1.5}',
    '{"id": "two", "text": "  \\n ", "tags": null}',
    '{"id": 3, "text": null, "note": "' + "y" * 101 + '"}',
    "not json",
    '{"id": 4}',
]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([(v,) for v in LINES], "value string")


@pytest.fixture(scope="module")
def stats(lines):
    return R.field_stats(lines).cache()


def test_key_types(stats):
    got = {(r.key, r.type): r.docs for r in R.json_key_types(stats).collect()}
    assert got == {
        ("id", "number"): 3, ("id", "string"): 1, ("text", "string"): 2, ("text", "null"): 1,
        ("tags", "array"): 1, ("tags", "null"): 1, ("meta", "object"): 1, ("flag", "bool"): 1,
        ("score", "number"): 1, ("note", "string"): 1}


def test_key_frequency(stats):
    rows = R.json_key_frequency(stats, 5).collect()
    assert (rows[0].key, rows[0].docs, float(rows[0].pct)) == ("id", 4, 80.0)
    assert [r.key for r in rows][1] == "text"


def test_text_fields(stats):
    rows = R.text_field_candidates(stats).collect()
    assert [(r.key, r.docs, r.mean_chars, r.min_chars, r.max_chars) for r in rows] == [
        ("text", 1, 150.0, 150, 150), ("note", 1, 101.0, 101, 101)]
    assert R.recommend_text_field(stats).first().text_field == "text"


def test_q15_null_and_blank_count_as_empty(stats):
    assert R.empty_text_count(stats, "text").first().empty_docs == 2


def test_q15_no_long_field(spark):
    short = spark.createDataFrame([('{"a": "b"}',)], "value string")
    row = R.profile_corpus(short).first()
    assert row.text_field is None and row.empty_docs == 0 and row.metadata_fields == []


def test_metadata(spark, stats):
    assert [r.key for r in R.metadata_coverage(stats, 5).collect()] == ["id"]
    other = R.field_stats(spark.createDataFrame([('{"a": 1, "b": "' + "z" * 200 + '"}',)], "value string"))
    assert [r.key for r in R.metadata_coverage(other, 1).collect()] == ["a"]


def test_profile(lines):
    row = R.profile_corpus(lines).first()
    assert (row.text_field, row.lines, row.malformed, row.empty_docs, row.fields) == ("text", 5, 1, 2, 7)
    sizes = sorted(map(len, LINES))
    assert row.median_chars == sizes[2] and row.max_chars == sizes[-1] and row.size_class == "small"


def test_sizes_in_characters_and_bytes(spark):
    row = R.doc_size_stats(spark.createDataFrame([("é",), ("abc",)], "value string")).first()
    assert (row.min_chars, row.min_bytes, row.median_chars, row.median_bytes) == (1, 2, 2.0, 2.5)


@pytest.mark.parametrize("mean, name", [(9_999, "small"), (10_000, "medium"), (99_999, "medium"), (100_000, "large")])
def test_batch_advice(apply, mean, name):
    assert R.batch_advice(mean)["size_class"] == name
    assert apply(R.size_class, [float(mean)], "double") == [name]


def test_sample_docs(spark):
    df = spark.createDataFrame([(i, "x" * 900) for i in range(9, 0, -1)], "i int, text string")
    assert [(r.i, len(r.text)) for r in R.sample_docs(df, ["i"], ["i", "text"]).collect()] == [(1, 500), (2, 500), (3, 500)]


# ---------------------------------------------------------------------------- reports


def test_histogram_edges(apply):
    edges = V.log_edges(5)
    assert len(edges) == 25 and edges[0] == 10 and edges[-1] == 1e5
    got = apply(lambda c: V.bin_of(c, edges), [9, 10, 14, 15, 100_000, 99_999, 100_001], "bigint")
    assert got == [-1, 0, 0, 1, 23, 23, 24]
    assert apply(lambda c: V.bin_of(c, edges), [None], "bigint") == [-1]
    assert apply(lambda c: V.bin_of(c, edges), edges, "double") == [*range(24), 23]


def both(spark, raw, cleaned=()):
    schema = "doc_id int, text string"
    return pair(spark.createDataFrame(raw, schema), spark.createDataFrame(list(cleaned), schema))


def test_lengths_reuse_count_columns(spark):
    df = both(spark, [(1, "a b")]).withColumn("char_count", F.lit(77)).withColumn("word_count", F.lit(None).cast("int"))
    row = V.length_stats(df).first()
    assert row.max_chars == 77 and row.max_words == 2


def test_q18_occurrences_and_documents(spark):
    df = both(spark, [(1, "a@b.co c@d.co e@f.co"), (2, "none")])
    row = V.pii_leak_report(df).where("kind = 'email'").first()
    assert (row.occurrences, row.docs_affected, row.occurrence_pct, row.docs_pct) == (3, 1, 150.0, 50.0)


def test_redaction_reports(spark):
    df = both(spark, [(2, "<EMAIL> b"), (1, "<EMAIL> a <IP>" + "x" * 400)], [(3, "none")])
    tags = {r.side: r.tags for r in V.redaction_tag_count(df).collect()}
    assert tags == {"input": 3, "output": 0}
    examples = {r.tag: r for r in V.redaction_examples(df, "doc_id").collect()}
    assert set(examples) == {"<EMAIL>", "<IP>"}
    assert examples["<EMAIL>"].first_doc == 1 and len(examples["<EMAIL>"].example) == 300


def test_integrity(spark):
    df = both(spark, [(1, "<b>"), (2, "var"), (3, "a    b"), (4, "ok"), (5, "classé")])
    row = V.integrity_scan(df).first()
    assert (row.html_docs, row.code_docs, row.whitespace_docs, row.html_pct) == (1, 1, 1, 20.0)


def test_uniqueness(spark):
    row = V.uniqueness_check(both(spark, [(1, "a"), (2, "a"), (2, "b")])).first()
    assert (row.docs, row.unique_ids, row.unique_texts, row.duplicate_texts) == (3, 2, 2, 1)
    assert row.duplicate_pct == pytest.approx(33.3333)


def test_random_sample_is_reproducible(spark):
    df = spark.range(500).withColumnRenamed("id", "doc_id")
    one = {r[0] for r in V.sample_docs_random(df, 50).collect()}
    assert one == {r[0] for r in V.sample_docs_random(df.repartition(7), 50).collect()}
    assert len(one) == 50 and one != {r[0] for r in V.sample_docs_random(df, 50, seed=1).collect()}
    assert V.sample_docs_random(df, 1000).count() == 500


def test_funnel_and_retention(spark):
    counts = spark.createDataFrame([(200, 100, 50)], "input bigint, kept bigint, final bigint")
    rows = V.stage_funnel(counts, ("input", "kept", "final")).orderBy("step").collect()
    assert [(r.stage, r.docs, r.pct_of_input) for r in rows] == [("input", 200, 100.0), ("kept", 100, 50.0), ("final", 50, 25.0)]
    assert V.retention(counts, "kept", "final").first().retention_pct == 50.0
    empty = spark.createDataFrame([(0, 0)], "a bigint, b bigint")
    assert V.retention(empty, "a", "b").first().retention_pct == 0.0


def test_language_reports(spark):
    df = both(spark, [(1, "the and of"), (2, "le et des"), (3, "the is to")])
    assert [(r.lang_label, r.docs) for r in V.language_distribution(df).collect()] == [("en", 2), ("fr", 1)]
    row = V.english_vs_other(df).first()
    assert (row.english, row.other, row.total, row.english_pct) == (2, 1, 3, 66.6667)


def test_toxicity_report(spark):
    df = both(spark, [(1, "a slut"), (2, "fine"), (3, None)])
    rows = {r.category: (r.docs, r.toxic_docs) for r in V.toxicity_scores(df).collect()}
    assert rows["toxicity"] == (3, 1) and rows["threat"] == (3, 0) and len(rows) == 6


# ------------------------------------------------------------------------- perplexity


def windows_by_hand(n, context, stride):
    out, covered = [], 0
    for begin in range(0, n, stride):
        end = min(begin + context, n)
        out.append((begin, end, end - covered))
        covered = end
        if end == n:
            break
    return out


@pytest.mark.parametrize("context, stride", [(4, 2), (5, 2), (4, 4), (3, 1)])
def test_windows(spark, context, stride):
    sizes = list(range(0, 16))
    df = spark.createDataFrame([(n, " ".join(["w"] * n)) for n in sizes], "doc_id int, text string")
    got = {}
    for r in PP.perplexity_windows(df, PP.Windows(context, stride)).orderBy("doc_id", "window").collect():
        got.setdefault(r.doc_id, []).append((r.begin, r.end, r.target_len))
    assert got == {n: windows_by_hand(n, context, stride) for n in sizes if n}
    with pytest.raises(ValueError):
        PP.Windows(2, 3)


@pytest.mark.parametrize("weighted", [False, True])
def test_perplexity_equals_a_direct_computation(spark, weighted):
    rng = random.Random(11)
    texts = [" ".join(rng.choices("a b c d".split(), k=n)) for n in (0, 1, 2, 5, 6, 9, 23)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    pairs = [list(zip(t.split(), t.split()[1:])) for t in texts]
    flat = [p for doc in pairs for p in doc]
    vocab = len({w for t in texts for w in t.split()})

    def loss(a, b):
        return -math.log((flat.count((a, b)) + 0.1) / (sum(x == a for x, _ in flat) + 0.1 * vocab))

    want = {}
    for i, doc in enumerate(pairs):
        losses, done = [], 0
        for begin, end, _ in windows_by_hand(len(texts[i].split()), 5, 2):
            scored = [loss(*p) for p in doc[max(done - 1, 0) : end - 1]]
            done = end
            if scored:
                losses.append(scored)
        if not losses:
            want[i] = None
        elif weighted:
            want[i] = math.exp(sum(map(sum, losses)) / sum(map(len, losses)))
        else:
            want[i] = math.exp(sum(sum(x) / len(x) for x in losses) / len(losses))
    rows = PP.perplexity(df, PP.Windows(5, 2), weighted=weighted).collect()
    got = {r.doc_id: None if math.isnan(r.perplexity) else r.perplexity for r in rows}
    assert got == {k: v if v is None else pytest.approx(v) for k, v in want.items()}
    part = PP.perplexity(df, PP.Windows(5, 2), weighted=weighted, scored=df.where("doc_id = 6")).collect()
    assert [r.doc_id for r in part] == [6] and part[0].perplexity == pytest.approx(want[6])


def test_perplexity_report(spark):
    scores = spark.createDataFrame(
        [("input", v) for v in (0.0, 10.0, 499.9, 500.0, 600.0, float("nan"))], "side string, perplexity double")
    row = PP.perplexity_stats(scores).first()
    assert row.docs == 6 and row.unscored == 1 and row.median == 499.9 and row["mean"] == pytest.approx(321.98)
    bins = {r.bin: r.docs for r in PP.perplexity_histogram(scores).collect()}
    assert bins == {-1: 1, 0: 2, 48: 2, 49: 1}  # unscored; 0 and 10; 499.9 and the closed right edge; above


def test_external_perplexity_model(spark):
    PP.SCORERS.register("length", PP.model_perplexity(lambda: 2.0, lambda m, texts: [m * len(t) for t in texts]))
    df = spark.createDataFrame([("abc",)], "text string")
    assert df.select(PP.SCORERS["length"](F.col("text"))["perplexity"]).first()[0] == 6.0


def test_bigrams_are_counted_inside_the_document(spark):
    text = "a b a b a b c a b " * 30
    df = spark.createDataFrame([(1, text), (2, "one"), (3, ""), (4, None), (5, "x x")], "doc_id bigint, text string")
    windows = PP.Windows(50, 20)
    rows = PP.bigrams(df, windows, "doc_id").collect()
    scored = [(r.doc, r.window, r.first, r.second) for r in rows if r["first"] is not None]
    assert len(scored) == len(set(scored)) and sum(r.n for r in rows if r.doc == 1) == len(text.split())
    assert [r.n for r in rows if r.doc == 2] == [1] and not any(r.doc in (3, 4) for r in rows)
    plan = plan_of(PP.bigrams(df, windows, "doc_id"))
    assert "Exchange" not in plan and "Python" not in plan


def test_stats_of_a_constant_side_need_no_nested_loop(spark):
    scores = spark.createDataFrame([(i, float(i)) for i in range(9)] + [(9, float("nan"))], "doc_id bigint, perplexity double")
    stats = PP.perplexity_stats(scores.withColumn("side", F.lit("input")))
    assert "NestedLoop" not in plan_of(stats)
    assert stats.select("side", "docs", "unscored", "mean", "median").first() == ("input", 10, 1, 4.0, 4.0)


def test_profile_of_values_that_are_no_objects(spark):
    values = ["[1, 2]", "5", '"s"', "null", "true", "{}", '{"a": {"b": 1}, "": 2, "é \\" k": " "}', "", "broken"]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "value string")
    assert sorted(map(tuple, R.fields(R.line_facts(df)).collect())) == [
        ("", "number", None, False), ("a", "object", None, False), ('é " k', "string", 1, True)]
    row = R.profile_corpus(df).first()
    assert (row.lines, row.malformed, row.fields) == (10, 3, 3)


def test_profile_parses_a_line_once(spark, lines, monkeypatch):
    staged = []
    plain = R.stage
    monkeypatch.setattr(R, "stage", lambda df, name: staged.append((name, plan_of(df))) or plain(df, name))
    out = R.profile_corpus(lines)
    parses = {name: plan.count("try_parse_json") + plan.count("parseJson(") for name, plan in staged}
    assert parses["lines"] >= 1 and all(n == 0 for name, n in parses.items() if name != "lines")
    assert "arse" not in plan_of(out).lower().replace("parsed", "") and "Python" not in plan_of(out)


def test_staged_bigrams_hold_no_hash_that_follows_from_their_words(spark, monkeypatch):
    staged = {}
    plain = PP.stage
    monkeypatch.setattr(PP, "stage", lambda df, name, **options: staged.update({name: df.columns}) or plain(df, name, **options))
    df = spark.createDataFrame([(1, "a b a b c"), (2, "a b"), (None, "b c"), (3, None)], "doc_id bigint, text string")
    got = {r.doc_id: (r.windows, r.perplexity) for r in PP.perplexity(df, k=0.5).collect()}
    assert "gram" not in staged["pairs"] and "gram" not in staged["grams"]
    # three words; a: 3 of b, b: 1 of a and 2 of c
    loss = {"ab": -math.log(3.5 / 4.5), "ba": -math.log(1.5 / 4.5), "bc": -math.log(2.5 / 4.5)}
    assert got[2] == (1, pytest.approx(math.exp(loss["ab"])))
    assert got[1] == (1, pytest.approx(math.exp((2 * loss["ab"] + loss["ba"] + loss["bc"]) / 4)))
