import random
import re

import pytest
from pyspark.sql import functions as F

from prosemill.functions import language as L
from prosemill.functions import patterns as P
from prosemill.functions import pii
from prosemill.functions import text as X
from prosemill.functions import toxicity as T
from prosemill.operators import quality as Q
from tests.conftest import plan_of

# ---------------------------------------------------------------------------- language


@pytest.mark.parametrize("n", [10, 11, 12, 13, 14, 39, 40, 41, 100])
def test_quarter_sample_with_size_10(apply, n):
    text = "".join(chr(0x4E00 + i) for i in range(n))
    got = apply(lambda c: L.sample(c, 10), [text])[0]
    start = min(n // 4, max(n - 10, 0))
    assert got == (text if n <= 10 else text[start : start + 10])


def test_q12_head_sample(apply):
    assert apply(lambda c: L.sample(c, 5, "head"), ["a\nb\ncdef"]) == ["a b c"]
    with pytest.raises(ValueError):
        L.sample(F.lit("a"), 5, "tail")


def test_model_text(apply):
    assert apply(L.model_text, [" a\r\n b  c "]) == ["a b c"]


def test_stopword_scorer(apply):
    rows = apply(L.stopword_scorer, ["the cat and the dog", "le chat et la souris", "zzz", ""])
    assert [(r.label, r.score) for r in rows] == [
        ("__label__en", 1.0), ("__label__fr", 0.75), ("__label__unknown", 0.0), ("__label__unknown", 0.0)]


def test_label_prefix(apply):
    assert apply(L.strip_label, ["__label__en", "en", "x__label__"]) == ["en", "en", "x__label__"]


def test_language_threshold_is_strict(spark):
    df = spark.createDataFrame([("the the the the zz le",)], "text string")  # score 4/5
    def n(limit):
        return Q.quality_filter(df, Q.FilterConfig(min_lang_score=limit)).count()
    assert [n(0.79), n(0.8)] == [1, 0]


def test_external_model_loads_once_and_survives_errors(spark):
    def load():
        return "__label__xx"

    def predict(model, texts):
        if "bad" in texts:
            raise RuntimeError("model failure")
        return [(model, 0.9)] * len(texts)

    L.SCORERS.register("fake", L.model_scorer(load, predict))
    df = spark.createDataFrame([(1, "good"), (2, "fine")], "i int, text string").coalesce(1)
    cfg = Q.FilterConfig(language_scorer="fake", target_language="__label__xx")
    assert Q.quality_filter(df, cfg).count() == 2
    assert plan_of(Q.quality_filter(df, cfg)).count("ArrowEvalPython") == 1
    bad = df.withColumn("text", F.lit("bad"))
    assert [r.lang_label for r in Q.annotate_quality(bad, cfg).collect()] == ["__label__unknown"] * 2


def test_missing_model_raises(spark):
    def load():
        raise FileNotFoundError("no model file")

    L.SCORERS.register("absent", L.model_scorer(load, None))
    df = spark.createDataFrame([("x",)], "text string")
    with pytest.raises(Exception, match="no model file"):
        Q.quality_filter(df, Q.FilterConfig(language_scorer="absent")).collect()
    with pytest.raises(KeyError, match="registered"):
        L.predict(F.lit("x"), "never")


def test_batches_are_split(spark):
    from prosemill.functions.scoring import batch_scorer

    def predict(model, texts):
        return [(float(len(texts)),)] * len(texts)

    scorer = batch_scorer(lambda: None, predict, "size double", batch_size=2)
    df = spark.range(5).coalesce(1).select(F.col("id").cast("string").alias("t"))
    assert [r[0] for r in df.select(scorer(F.col("t"))["size"]).collect()] == [2.0, 2.0, 2.0, 2.0, 1.0]


# ----------------------------------------------------------------------- personal data


@pytest.mark.parametrize("text, redacted", [
    ("write a@b.co now", "write <EMAIL> now"),
    ("x@y.C|D", "<EMAIL>"),  # the bar is part of the class
    ("x@y.c", "x@y.c"),
    ("999.1.1.1", "<IP>"),
    ("1.2.3.4.5", "<IP>.5"),
    ("call 555-123-4567.", "call <PHONE>."),
    ("+1 555-123-4567", "+1 <PHONE>"),  # no word boundary before the plus
    ("(555) 123-4567", "(<PHONE>"),
    ("12345678901", "12345678901"),
    ("5551234567", "<PHONE>"),
    ("a@b.co 10.0.0.1 555 123 4567", "<EMAIL> <IP> <PHONE>"),
    ("é5551234567", "é5551234567"),
])
def test_redaction(apply, text, redacted):
    assert apply(pii.redact, [text]) == [redacted]
    assert apply(pii.has_pii, [text]) == [redacted != text]


def test_redaction_equals_python_and_leaves_nothing(apply):
    rng = random.Random(3)
    parts = ["a@b.com", "1.2.3.4", "555-123-4567", "(555) 123 4567", "+44 555.123.4567", "x", " ", "é", ",", "\n", "7"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(3000)]

    def model(t):
        for pattern, tag in pii.KINDS.values():
            t = re.sub(pattern, tag, t)
        return t

    out = apply(pii.redact, texts)
    assert out == [model(t) for t in texts]
    assert sum(apply(lambda c: pii.leaks(c, "email"), out)) == 0
    assert sum(apply(lambda c: pii.leaks(c, "ip"), out)) == 0


def test_drop_action(spark):
    df = spark.createDataFrame([("the mail of a@b.co",), ("the cat and the dog",)], "text string")
    assert [r.text for r in Q.quality_filter(df, Q.FilterConfig(pii_action="drop")).collect()] == ["the cat and the dog"]
    with pytest.raises(ValueError):
        Q.FilterConfig(pii_action="hide")


# ---------------------------------------------------------------------------- toxicity


def test_toxic_ratio_is_strict(apply):
    text = "idiot " + "word " * 999
    assert apply(lambda c: T.is_toxic(c, ("idiot",), 0.001), [text]) == [False]
    assert apply(lambda c: T.is_toxic(c, ("idiot",), 0.001), [text + "IDIOT"]) == [True]
    assert apply(lambda c: T.is_toxic(c, ("idiot",), 0.0), [text]) == [True]


def test_toxic_words_are_whole_and_escaped(apply):
    assert apply(lambda c: T.hits(c, ("a.b", "été")), ["a.b axb ÉTÉ étés A.B"]) == [3]
    assert apply(lambda c: T.hits(c, ()), ["anything"]) == [0]
    assert apply(lambda c: T.is_toxic(c, ()), ["anything"]) == [False]


def test_scores_agree_with_the_filter(apply):
    texts = ["idiot " + "word " * n for n in (0, 998, 999, 1000, 5000)] + ["", "fine"]
    scorer = T.lexicon_scorer({"toxicity": ("idiot",)})
    scores = apply(scorer, texts)
    toxic = apply(lambda c: T.is_toxic(c, ("idiot",)), texts)
    assert [s.toxicity > 0.5 for s in scores] == toxic
    assert set(scores[0].asDict()) == set(P.TOXICITY_CATEGORIES)
    assert scores[0].threat == 0.0


# ----------------------------------------------------------------------------- quality


@pytest.mark.parametrize("text, ratio", [
    ("", 1.0), ("abc", 0.0), ("ab cd!!!!!", 0.5), ("<EMAIL>", 2 / 7), ("é", 0.5),
    ("²三٣", 0.0), ("_", 1.0),
])
def test_punc_ratio(apply, text, ratio):
    assert apply(X.punc_ratio, [text]) == [pytest.approx(ratio)]


def test_punc_limit_is_inclusive(spark):
    df = spark.createDataFrame([("the and" + "!" * 3,), ("the and" + "!" * 4,)], "text string")
    assert Q.quality_filter(df).count() == 1


def test_q17_column_order_and_passthrough(spark):
    df = spark.createDataFrame([("the mail of a@b.co", 1)], "text string, n int")
    out = Q.quality_filter(df)
    assert out.columns == ["text", "n"] and out.first().text == "the mail of <EMAIL>"
    other = spark.createDataFrame([(1,)], "n int")
    assert Q.quality_filter(other).collect() == other.collect()
    assert Q.quality_filter(df, Q.FilterConfig(enabled=False)).first().text == "the mail of a@b.co"


def test_punctuation_is_measured_after_redaction(spark):
    text = "the a@b.co is to"
    df = spark.createDataFrame([(text,)], "text string")
    assert Q.quality_filter(df, Q.FilterConfig(max_punc_ratio=2 / len("the <EMAIL> is to"))).count() == 1
    assert Q.annotate_quality(df).first().punc_ratio == pytest.approx(2 / len("the <EMAIL> is to"))


def test_language_runs_before_the_costly_filters(spark):
    df = spark.createDataFrame([("x",)], "text string")
    plan = plan_of(Q.quality_filter(df))
    assert plan.count("<EMAIL>") == 1  # redaction computed once
    lines = plan.split("\n")
    lang = next(i for i, line in enumerate(lines) if "__label__fr" in line)
    toxic = next(i for i, line in enumerate(lines) if "wetback" in line)
    assert toxic < lang  # higher in the plan: later


def test_batches_by_characters():
    import random

    from prosemill.functions.scoring import char_batches

    rng = random.Random(1)
    texts = ["x" * rng.choice((0, 1, 5, 30, 400)) for _ in range(200)] + ["y" * 5000]
    for most, size in ((1000, None), (1000, 7), (1, None), (10**9, None)):
        batches = char_batches(texts, most, size)
        assert sorted(i for b in batches for i in b) == list(range(len(texts)))
        for b in batches:
            longest = max(len(texts[i]) for i in b)
            assert len(b) == 1 or longest * len(b) <= most
            assert size is None or len(b) <= size
    assert char_batches([], 10) == [] and len(char_batches(texts, 10**9)) == 1


def test_scores_do_not_depend_on_the_batches(spark):
    from prosemill.functions.scoring import LetterModel, batch_scorer

    weights = [i / 8 for i in range(26)]
    texts = ["", None, "abc", "ABC é🙂 zz", "q" * 3000] + ["word " * (i % 40) for i in range(100)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3)
    want = {i: sum(weights[ord(c) - 97] for c in t or "" if "a" <= c <= "z") for i, t in enumerate(texts)}
    for most in (1, 500, 10**6, None):
        def bounded(model, own, most=most):
            assert most is None or len(own) == 1 or len(own) * max(map(len, own)) <= most
            return model(own)

        scorer = batch_scorer(lambda: LetterModel(weights), bounded, "score double", max_chars=most)
        assert {r.i: r.s for r in df.select("i", scorer("t")["score"].alias("s")).collect()} == want
    with pytest.raises(Exception, match="0 results"):
        df.select(batch_scorer(lambda: None, lambda m, own: [], "score double")("t")).collect()


def test_first_characters_are_looked_at_before_the_alternatives(spark):
    assert "(?=[" in P.whole_words(("the", "of")) and "(?=" not in P.whole_words(("", "a"))
    texts = ["The -x of-the x. of", "off bathe", "", None, "OF"]
    words = ("the", "of", "-x")
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(T.hits(F.col("text"), words).alias("got"), F.regexp_count(
        F.col("text"), F.lit(r"(?iuU)\b(the|of|\-x)\b")).cast("bigint").alias("want")).collect()
    assert [r.got for r in rows] == [r.want for r in rows] and rows[0].got == 4
