import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from prosemill.operators import tokenize as T
from prosemill.plans.corpus_queries import _ranks
from prosemill.sources.tokens import checked_format, write_tokens
from tests.conftest import plan_of

RANKS = _ranks()
pytestmark = pytest.mark.skipif(RANKS is None, reason="no rank file installed")


def cfg(**kw):
    return T.TokenizeConfig(ranks_path=RANKS, **kw)


def docs(spark, *texts):
    return spark.createDataFrame([(f"d{i}", t, "s") for i, t in enumerate(texts)], "doc_id string, text string, source string")


def ids(spark, *texts, **kw):
    return [r.input_ids for r in T.tokenize(docs(spark, *texts), cfg(**kw)).orderBy("doc_id").collect()]


def test_golden_ids_and_round_trip(spark):
    texts = ["Hello world", "naïve café 日本語\n\n  x", ""]
    got = ids(spark, *texts)
    assert got[0] == [15496, 995] and got[2] == []
    enc = T.encoder("gpt2", RANKS)
    assert [enc.decode(x) for x in got] == texts


@pytest.mark.parametrize("limit, n", [(None, 9), (0, 9), (4, 4), (100, 9)])
def test_truncation_and_count_after_it(spark, limit, n):
    row = T.tokenize(docs(spark, "a b c d e f g h i"), cfg(max_length=limit)).first()
    assert len(row.input_ids) == row.token_count == n


def test_q5_special_token_text(spark):
    text = "x<|endoftext|>y"
    assert ids(spark, text) == [[]]  # fails, the row stays
    plain, parsed = ids(spark, text, special="as_text")[0], ids(spark, text, parse_special=True)[0]
    assert 50256 not in plain and len(plain) > 3
    assert parsed == [87, 50256, 88]  # Q6: parsed, nothing added
    with pytest.raises(ValueError):
        cfg(special="maybe")


def test_columns(spark):
    df = docs(spark, "a").withColumn("other", F.lit(1)).withColumn("ingest_time", F.lit(1.0))
    assert T.tokenize(df, cfg()).columns == ["doc_id", "input_ids", "token_count", "source", "ingest_time"]
    assert T.tokenize(df, cfg(keep_text=True)).columns[-1] == "text"
    assert T.tokenize(df, cfg()).schema["input_ids"].dataType.simpleString() == "array<bigint>"
    assert T.tokenize(df.drop("text"), cfg()).count() == 0


def test_anomalies_are_observed_in_the_writing_job(spark, tmp_path):
    seen = Observation()
    df = docs(spark, "", "ok", "bad <|endoftext|>", "a " * 100_001)
    T.run_tokenization(df, cfg(max_length=5), str(tmp_path / "t"), seen)
    assert seen.get == {"docs": 4, "empty_docs": 1, "long_docs": 1, "failed_docs": 1}


def test_encoded_once(spark):
    assert plan_of(T.tokenize(docs(spark, "a"), cfg(max_length=3)).where("token_count > 0")).count("ArrowEvalPython") == 1


def test_unknown_encoding_becomes_the_fallback(monkeypatch):
    import tiktoken

    asked = []

    def get(name):
        asked.append(name)
        if name != T.FALLBACK_ENCODING:
            raise ValueError(name)
        return "encoder"

    monkeypatch.setattr(tiktoken, "get_encoding", get)
    assert T.encoder("no such model", None) == "encoder"
    assert asked == ["no such model", "gpt2"]
    T.encoder.cache_clear()


def test_formats(spark, tmp_path):
    with pytest.warns(UserWarning, match="unknown export format"):
        assert checked_format("orc") == "parquet"
    assert checked_format("json") == "jsonl"  # Q7
    df = T.tokenize(docs(spark, "a b", "c"), cfg())
    for fmt, suffix in (("parquet", ".snappy.parquet"), ("jsonl", ".json"), ("json", ".json")):
        path = str(tmp_path / fmt)
        write_tokens(df, path, fmt)
        write_tokens(df, path, fmt)  # replaces
        assert any(f.endswith(suffix) for f in os.listdir(path))
        back = spark.read.parquet(path) if fmt == "parquet" else spark.read.schema(df.schema).json(path)
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_step_switches(spark, tmp_path):
    df = docs(spark, "a")
    assert T.run_tokenization(df, cfg(enabled=False), str(tmp_path / "no")) is None
    assert not (tmp_path / "no").exists()
    target = T.run_tokenization(df, cfg(output_path=str(tmp_path / "cfg")), str(tmp_path / "arg"))
    assert target == str(tmp_path / "arg") and not (tmp_path / "cfg").exists()
    assert T.run_tokenization(df, cfg(output_path=str(tmp_path / "cfg"))) == str(tmp_path / "cfg")


def test_results_leave_the_worker_in_parts(spark, monkeypatch):
    """One batch of many documents comes out whole, though no more than a few ids are held."""
    monkeypatch.setattr(T, "_BATCH", 3)
    monkeypatch.setattr(T, "encoder", lambda *_: _Letters())
    cfg = T.TokenizeConfig(special="as_text")
    encode, decode = T.encode_udf(cfg).func, T.decode_udf(cfg).func
    texts = pa.array(["ab", None, "", "cde", "f"])
    parts = list(encode(iter([texts])))
    ids = pa.chunked_array([p.field("ids") for p in parts])
    assert len(parts) > 1 and ids.to_pylist() == [[97, 98], [], [], [99, 100, 101], [102]]
    assert [e is None for p in parts for e in p.field("error").to_pylist()] == [True, False, True, True, True]
    lists = pa.array([[97, 98], None, [], [99, 100], [102]], pa.list_(pa.int64()))
    assert [t for p in decode(iter([lists])) for t in p.to_pylist()] == ["ab", None, "", "cd", "f"]


class _Letters:
    def encode_to_numpy(self, text, **_):
        return np.array([ord(c) for c in text], np.uint32)

    def decode(self, ids):
        return "".join(map(chr, ids))
