import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from prosemill.operators import language_model as M
from prosemill.operators.quality import FilterConfig, annotate_quality, quality_filter
from prosemill.plans import config as C
from prosemill.plans.corpus_run import run
from prosemill.plans.language_queries import HELD_OUT, language_agreement
from tests.conftest import plan_of
from tests.test_run import settings

DOCS = "doc_id bigint, text string, lang string"
SF = "/root/testdata/sf0.01"
ROWS = [
    (1, "the cat and the dog went home with the other people", "en"), (2, "That is what they said to the man!", "en"),
    (3, "le chat et le chien sont dans la maison", "fr"), (4, "Les gens disent que c'était bien.", "fr"),
    (5, "это большой дом на улице", "ru"), (6, "no label", None), (7, "...", "xx"), (8, None, "en")]


def grams(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    t = f" {' '.join(words)} " if words else ""
    return Counter(t[i:i + 3] for i in range(len(t) - 2))


def brute(rows, text, k=0.5):
    """(label, score) of a text."""
    counts, docs = {}, Counter(lang for _, _, lang in rows if lang)
    for _, t, lang in rows:
        if lang:
            counts.setdefault(lang, Counter()).update(grams(t))
    counts = {x: c for x, c in counts.items() if c}
    docs = {x: docs[x] for x in counts}
    vocabulary, own = len(set().union(*counts.values())), grams(text)
    if not own:
        return "__label__unknown", 0.0
    s = {x: math.log(docs[x] / sum(docs.values())) + sum(n * math.log((c[g] + k) / (sum(c.values()) + k * vocabulary)) for g, n in own.items())
         for x, c in counts.items()}
    best = max(sorted(s), key=s.get)
    return f"__label__{best}", 1 / sum(math.exp(v - s[best]) for v in s.values())


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model"))
    return path, M.train_language_model(spark.createDataFrame(ROWS, DOCS).repartition(4), path)


def test_counts(spark):
    got = {(r.lang, r.gram): r.n for r in M.gram_counts(spark.createDataFrame(ROWS, DOCS)).collect()}
    want = Counter()
    for _, text, lang in ROWS:
        want.update({(lang, g): n for g, n in grams(text).items()} if lang else {})
    assert got == dict(want)


TEXTS = ["the house and the people", "dans la maison", "улица и дом", "Zyx qq", "", None, "12 !", "é", "the le the le", "a" * 5000]


@pytest.mark.parametrize("broadcast_grams", [0, 10**6])
def test_scores_equal_the_plain_model(spark, model, broadcast_grams):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").withColumn("gram", F.lit(1)).withColumn("rows", F.lit(9))
    out = {r.doc_id: r for r in M.predict_language(df, model[1], broadcast_grams=broadcast_grams).collect()}
    assert len(out) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        label, score = brute(ROWS, text)
        assert out[i].label == label and out[i].score == pytest.approx(score, rel=1e-9) and out[i].rows == 1, text


def test_repeated_and_null_ids(spark, model):
    df = spark.createDataFrame([(1, "the house")] * 5 + [(None, "dans la maison")] * 2 + [(2, "the house")], "doc_id bigint, text string")
    for limit in (0, 10**6):
        out = {r.doc_id: r for r in M.predict_language(df, model[1], broadcast_grams=limit).collect()}
        assert out[1].score == pytest.approx(out[2].score) and (out[1].rows, out[2].rows, out[None].rows) == (5, 1, 2)
    kept = M.filter_language(df, model[1], out[1].label, 0.5)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 1, 1, 1, 1, 2]


def test_model_is_kept_and_replaced(spark, model, tmp_path):
    again = M.load_language_model(spark, model[0])
    assert (again.languages, again.totals, again.docs, again.vocabulary) == tuple(getattr(model[1], x) for x in ("languages", "totals", "docs", "vocabulary"))
    assert again.languages == ("en", "fr", "ru") and again.docs == (3, 2, 1)  # xx has no letters
    ranges = again.grams.groupBy(F.input_file_name().alias("f")).agg(F.min(F.xxhash64("gram")).alias("a"), F.max(F.xxhash64("gram")).alias("b")).collect()
    ends = sorted((r.a, r.b) for r in ranges)
    assert all(x[1] < y[0] for x, y in zip(ends, ends[1:]))
    other = M.train_language_model(spark.createDataFrame(ROWS[:2], DOCS), str(tmp_path))
    assert M.train_language_model(spark.createDataFrame(ROWS[2:4], DOCS), str(tmp_path)).languages == ("fr",) != other.languages


def test_nothing_to_learn_from(spark, tmp_path):
    none = M.train_language_model(spark.createDataFrame(ROWS, DOCS).limit(0), str(tmp_path))
    df = spark.createDataFrame([(1, "the house"), (2, None)], "doc_id bigint, text string")
    assert [(r.label, r.score) for r in M.predict_language(df, none).collect()] == [("__label__unknown", 0.0)] * 2


def test_agreement_on_rows_held_out_and_plan(spark):
    rows = [r for r in language_agreement(spark, SF).collect() if r.held_out]
    assert sum(r.docs for r in rows) > 100 and sum(r.agree for r in rows) / sum(r.docs for r in rows) > 0.98
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    learned = M.train_language_model(docs.where(f"NOT {HELD_OUT.format(string='STRING')}"), S_path(spark))
    for limit in (0, 10**6):
        plan = plan_of(M.predict_language(docs, learned, broadcast_grams=limit))
        assert "Python" not in plan and "Pandas" not in plan and "NestedLoop" not in plan


def S_path(spark):
    from prosemill.sources.storage import scratch_path

    return scratch_path(spark, "model")


def test_filter_with_a_trained_model(spark, model):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(TEXTS)] + [(None, "the house")], "doc_id string, text string")
    cfg = FilterConfig(language_scorer="ngram", language_model_path=model[0], min_lang_score=0.5, enable_toxicity=False, enable_pii=False)
    want = [str(i) for i, t in enumerate(TEXTS) if brute(ROWS, t)[0] == "__label__en" and brute(ROWS, t)[1] > 0.5]
    assert sorted(r.doc_id for r in quality_filter(df, cfg).collect()) == want
    labels = {r.doc_id: r.lang_label for r in annotate_quality(df, cfg).collect() if r.doc_id}
    assert labels == {str(i): brute(ROWS, t)[0] for i, t in enumerate(TEXTS)}
    with pytest.raises(ValueError, match="language_model_path"):
        FilterConfig(language_scorer="ngram")


def test_run_with_a_trained_model(spark, model, tmp_path):
    plain = settings(tmp_path)
    trained = {**plain["filtering"], "language_scorer": "ngram", "language_model_path": model[0]}
    report = run(spark, C.from_dict({**plain, "filtering": trained, "tokenization": {"enabled": False}}))
    assert report.counts["filtered"] == 4 and report.counts["deduplicated"] == 3


def test_unknown_paths_are_named():
    with pytest.warns(UserWarning, match="paths.outptu has no effect"):
        C.from_dict({"ingestion": {"input_path": "x"}, "paths": {"outptu": "y"}})


def test_rare_and_frequent_terms_sum_up_as_with_a_small_table(spark, monkeypatch):
    from prosemill.operators import joins as J

    monkeypatch.setattr(J, "BROADCAST_TERMS", 3)
    terms = spark.createDataFrame([(1, "a", 1), (1, "b", 0), (1, "b", 0), (1, "z", 0), (2, None, 1), (None, "a", 1), (3, "c", 1)], "id int, t string, rows int")
    table = spark.createDataFrame([("a", 1.0, 9), ("b", 10.0, 2), ("c", 100.0, 1)], "t string, v double, n bigint")
    n = F.when(F.col("t").isNotNull(), F.col("_n")).otherwise(0)
    got = [sorted(map(tuple, J.term_sums(terms, table.select("t", "v"), "t", table.select("t", "n"), 12, small, seen=n,
                                         v=n * F.coalesce("v", F.lit(0.5))).collect()), key=str) for small in (True, False)]
    assert got[0] == got[1] == sorted([(1, 1, 4, 21.5), (2, 1, 0, 0.0), (None, 1, 1, 1.0), (3, 1, 1, 100.0)], key=str)


def test_grams_of_characters_beyond_the_basic_plane(spark):
    df = spark.createDataFrame([(1, "a\U00010400\U00010428b"), (2, "")], "id int, text string")
    rows = [(r.id, r.pos, r.gram) for r in M.with_grams(df.select("id", "text"), F.col("text"), 3).drop("text").collect()]
    x = "\U00010428"
    assert sorted(rows, key=str) == sorted([(1, 0, f" a{x}"), (1, 1, f"a{x}{x}"), (1, 2, f"{x}{x}b"), (1, 3, f"{x}b "), (2, None, None)], key=str)
