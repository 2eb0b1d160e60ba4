import itertools
import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from prosemill.llm import language_spans as M

DOCS = "doc_id bigint, text string, lang string"
SF = "/root/testdata/sf0.01"


def word_list(text):
    """(start, end, script) of runs of letters and marks of one script, plainly."""
    out, last = [], None
    for i, c in enumerate(text):
        kind = unicodedata.category(c)[0]
        script = unicodedata.name(c, "?").split(" ")[0] if kind in "LM" else None
        if script == "COMBINING":
            script = last
        if script and script == last:
            out[-1][1] = i + 1
        elif script:
            out.append([i, i + 1, script])
        last = script
    return [tuple(x) for x in out]


def plain_slots(word):
    chars = " " + "".join(c.lower() if len(c.lower()) == 1 else c for c in word) + " "
    out = Counter()
    for n in M.GRAMS:
        for i in range(len(chars) - n + 1):
            out[int(M.slot([np.array([ord(c)]) for c in chars[i:i + n]])[0])] += 1
    return out


TEXTS = ["", "Hello, wörld! it's 3x5", "Привет мир and more", "日本語テキスト", "étude naïve Ǆ İx", "नमस्ते दुनिया", "... 123", "a", "ab1cd-ΕΛ"]


def test_words_and_ngrams():
    words = M.cut_words(TEXTS)
    got = [[] for _ in TEXTS]
    for d, s, e, k in zip(words.doc, words.start, words.end, words.script):
        got[d].append((s, e))
    assert got == [[x[:2] for x in word_list(t)] for t in TEXTS]
    per_word = [Counter() for _ in words.doc]
    for slots, word in words.grams:
        for w, k in zip(word, slots):
            per_word[w][int(k)] += 1
    want = [plain_slots(t[s:e]) for t in TEXTS for s, e, _ in word_list(t)]
    assert per_word == want


def test_viterbi_equals_all_labellings():
    rng = np.random.default_rng(3)
    sizes = [5, 1, 7, 3, 6, 6]
    doc = np.repeat(np.arange(len(sizes)) * 2, sizes)
    for trial in range(60):
        scores = rng.normal(0, rng.choice((0.3, 2, 6)), (len(doc), 3)) + rng.normal(0, 2, 3)
        scores[rng.random(scores.shape) < 0.1] = M._NEVER
        penalty = rng.choice((0.5, 3.0, 8.0))
        label = M.viterbi(scores, doc, penalty)
        value = lambda lab, s: sum(s[i, k] for i, k in enumerate(lab)) - penalty * sum(a != b for a, b in zip(lab, lab[1:]))  # noqa: E731, B023
        for d in set(doc):
            own, mine = scores[doc == d], label[doc == d]
            best = max(value(x, own) for x in itertools.product(range(3), repeat=len(own)))
            assert value(mine, own) == pytest.approx(best, abs=1e-5)


def test_settled_texts_are_those_without_a_switch():
    rng = np.random.default_rng(4)
    scores = rng.normal(0, 1, (4000, 3)) + [2, 0, 0]
    doc = np.repeat(np.arange(100), 40)
    top, sure = M.settled(scores, M._firsts(doc), 12.0)
    assert sure.mean() > 0.5 and (M.viterbi(scores, doc, 12.0).reshape(100, 40) == top[:, None])[sure].all()


def test_counts_and_model(spark):
    docs = [(i, t, ("a", "b", None)[i % 3]) for i, t in enumerate(TEXTS * 4)] + [(None, "never", "c"), (500, None, "d")]
    df = spark.createDataFrame(docs, DOCS).repartition(5)
    model = M.learn_languages(df)
    known = [r for r in docs if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 and r[2] and r[1] is not None]
    assert model.names == ("a", "b")
    counts = np.zeros((2, M.SLOTS + 256), int)
    script = M._characters()[0]
    for _, t, lang in known:
        for s, e, _ in word_list(t):
            for k, n in plain_slots(t[s:e]).items():
                counts[model.names.index(lang), k] += n
            counts[model.names.index(lang), M.SLOTS + int(script[ord(t[s])])] += e - s
    want = M.model_of(model.names, counts)
    assert np.array_equal(want.loss, model.loss) and np.array_equal(want.written, model.written)


ENGLISH = "the cat and the dog went to the house with the other people of that town"
FRENCH = "les enfants sont dans la maison avec le chien et les autres gens du village"
RUSSIAN = "это большой дом который стоит на улице и все люди там живут очень хорошо"


def model():
    rows = pa.RecordBatch.from_pydict({"lang": ["en", "fr", "ru"], "text": [ENGLISH, FRENCH, RUSSIAN]})
    counts = np.zeros((3, M.SLOTS + 256), np.int64)
    for b in M._counts([rows]):
        counts["en fr ru".split().index(b["lang"][0].as_py())][b["slot"].to_numpy()] = b["n"].to_numpy()
    return M.model_of(("en", "fr", "ru"), counts)


def test_spans_of_a_mixed_text(spark):
    text = f"{ENGLISH}. {FRENCH}! {RUSSIAN}?"
    docs = spark.createDataFrame([(1, text, None)], DOCS)
    row = M.identify_languages(docs, model()).first()
    assert [(s.lang, text[s.start:s.end]) for s in row.spans] == [("en", ENGLISH), ("fr", FRENCH), ("ru", RUSSIAN)]
    assert row.lang_pred == "fr" and 0.2 < row.score < 0.5


def test_odd_rows(spark):
    docs = [(None, ENGLISH, "x"), (1, None, "en"), (2, "", "fr"), (3, "123 ... !", "fr"), (4, FRENCH, None), (4, FRENCH, None), (5, "ΑΒΓ δεζ", None),
            (6, f"{RUSSIAN} " * 20_000, None), (7, "я" * 300_000, None)]
    df = spark.createDataFrame(docs, DOCS).withColumn("spans", F.lit(1)).withColumn("score", F.lit(1)).withColumn("id", F.lit(1))
    out = M.identify_languages(df, model()).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(docs) and [by[i].lang_pred for i in (None, 1, 2, 3, 4, 6, 7)] == ["en", "und", "und", "und", "fr", "ru", "ru"]
    assert by[5].lang_pred in ("en", "fr", "ru") and by[1].score == 0 and by[1].spans == [] and not by[None].held_out
    assert all(0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert M.identify_languages(df.limit(0), model()).count() == 0
    assert {r.lang_pred for r in M.identify_languages(df, M.learn_languages(df.limit(0))).collect()} == {"und"}


def test_too_many_languages_are_refused(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError, match="languages"):
        M.learn_languages(rows)


def test_held_out_accuracy(spark):
    out = M.op11_language_spans(spark, SF)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = out.join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and len(held) > 100
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.98 and np.mean([r.lang_pred == r.lang for r in rows]) >= 0.99
