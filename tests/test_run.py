import json
import os

import pytest
from pyspark.sql import functions as F

from prosemill.plans import config as C
from prosemill.plans.corpus_run import prepare, run
from prosemill.plans.corpus_queries import _ranks
from prosemill.sources import jsonl as J
from prosemill.sources import storage as S

EN = "The {} of the words and the sentences in that text is to be read by the people that know the language. "


def write_corpus(path):
    texts = [EN.format(w) * 2 for w in ("first", "second", "first")] + [
        "short", "<p>" + EN.format("third") + "</p> mail a@b.co", "le texte et les mots des gens qui lisent un texte " * 3]
    with open(path, "w", encoding="utf-8") as out:
        for i, text in enumerate(texts):
            out.write(json.dumps({"text": text, "url": f"http://x/{i}"}, ensure_ascii=False) + "\n")
        out.write("broken line\n")


def settings(tmp_path, **changes):
    write_corpus(tmp_path / "raw.jsonl")
    return {
        "compute_counts": True,
        "paths": {"output_file": str(tmp_path / "out.jsonl"), "processed_dir": str(tmp_path / "tokens")},
        "ingestion": {"input_path": str(tmp_path / "raw.jsonl"), "min_text_length": 100, "batch_size": 2000},
        "filtering": {"toxic_words": ["zzz"]},
        "tokenization": {"ranks_path": _ranks(), "max_length": 16, "enabled": _ranks() is not None},
        **changes,
    }


def test_defaults_and_names():
    with pytest.warns(UserWarning) as told:
        cfg = C.from_dict({"ingestion": {"input_path": "x"}, "tokenization": {"add_special_tokens": True},
                           "deduplication": {"max_lsh_items": 7}, "order_by": ["url"], "unknown": {"a": 1}})
    said = " ".join(str(w.message) for w in told)
    assert "max_lsh_items has no effect" in said and "unknown has no effect" in said
    assert cfg.ingestion.min_text_length == 100 and cfg.filtering.min_lang_score == 0.65
    assert cfg.tokenization.parse_special and cfg.order_by == ("url",)
    assert C.RunConfig().order_by == ()
    with pytest.raises(ValueError, match="input_path"):
        C.from_dict({})


def test_a_language_model_without_scorer_is_refused():
    section = {"language_model_path": "lid.bin"}
    with pytest.raises(ValueError, match="lid.bin"):
        C.from_dict({"ingestion": {"input_path": "x"}, "filtering": section})
    with pytest.raises(ValueError, match="not registered"):
        C.from_dict({"ingestion": {"input_path": "x"}, "filtering": {**section, "language_scorer": "none"}})


def test_malformed_lines_stop_a_run_if_told_to(spark, tmp_path):
    cfg = C.from_dict(settings(tmp_path, fail_on_malformed=True))
    with pytest.raises(Exception, match="malformed line: broken line"):
        run(spark, cfg)


def test_load_yaml(tmp_path):
    (tmp_path / "c.yaml").write_text("ingestion:\n  input_path: in.jsonl\nfiltering:\n  toxic_words: [a, b]\n")
    cfg = C.load_config("c.yaml", root=str(tmp_path))
    assert cfg.filtering.toxic_words == ("a", "b")
    with pytest.raises(FileNotFoundError):
        C.load_config("none.yaml", root=str(tmp_path))


def test_whole_run(spark, tmp_path):
    report = run(spark, C.from_dict(settings(tmp_path)))
    assert report.counts == {"malformed": 1, "ingested": 5, "filtered": 4, "deduplicated": 3}
    assert report.retention_pct == pytest.approx(60.0)
    rows = J.read_jsonl(spark, report.output_path, "doc_id STRING, text STRING, url STRING, source STRING").collect()
    assert len(rows) == 3 and {r.source for r in rows} == {"raw.jsonl"}
    assert any("<EMAIL>" in r.text and "<p>" not in r.text for r in rows)
    assert report.output_mb > 0
    if report.tokens_path:
        tokens = spark.read.parquet(report.tokens_path)
        assert tokens.count() == 3 and tokens.agg(F.max("token_count")).first()[0] == 16
        assert report.token_anomalies["docs"] == 3
    again = run(spark, C.from_dict(settings(tmp_path)))  # replaces the outputs
    assert again.counts == report.counts


def test_switches_and_single_file(spark, tmp_path):
    cfg = C.from_dict(settings(
        tmp_path, compute_counts=False, single_file=True, filtering={"enabled": False},
        deduplication={"enabled": False}, tokenization={"enabled": False}))
    report = run(spark, cfg)
    assert report.counts == {} and report.retention_pct is None and report.tokens_path is None
    assert os.path.isfile(report.output_path)
    lines = [json.loads(line) for line in open(report.output_path, encoding="utf-8")]
    assert len(lines) == 5 and [r["doc_id"] for r in lines] == sorted(r["doc_id"] for r in lines)


def test_missing_input_fails(spark, tmp_path):
    values = settings(tmp_path)
    values["ingestion"]["input_path"] = str(tmp_path / "none.jsonl")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run(spark, C.from_dict(values))


def test_result_does_not_depend_on_partitioning(spark, tmp_path):
    cfg = C.from_dict(settings(tmp_path))
    raw = J.read_jsonl(spark, cfg.ingestion.input_path)
    one, many = ({(r.doc_id, r.text, r.url) for r in prepare(raw.repartition(n), cfg).collect()} for n in (1, 6))
    assert one == many


# ------------------------------------------------------------------------------ sinks


def test_export_keeps_characters_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([("1", "é</b>\n", None)], "doc_id string, text string, url string")
    J.write_jsonl(df.coalesce(1), str(tmp_path / "o"))
    (part,) = [f for f in os.listdir(tmp_path / "o") if f.endswith(".json")]
    line = (tmp_path / "o" / part).read_text(encoding="utf-8").strip()
    assert "é" in line and json.loads(line) == {"doc_id": "1", "text": "é</b>\n", "url": None}


def test_export_columns(spark):
    df = spark.createDataFrame([("1", "t", "s", 2)], "doc_id string, text string, source string, n int")
    assert J.export_columns(df).columns == ["doc_id", "text", "source"]


def test_single_file_is_replaced_as_a_whole(spark, tmp_path, monkeypatch):
    def frame(n):
        return spark.range(n).select(F.format_string("%05d", "id").alias("doc_id"), F.lit("text").alias("text")).repartition(5)

    def ids():
        return [json.loads(line)["doc_id"] for line in open(path)]

    path = str(tmp_path / "s.jsonl")
    for n in (100, 1000):
        assert J.write_jsonl_single(frame(n), path, ("doc_id",)) == path
        assert ids() == [f"{i:05d}" for i in range(n)]
    calls = []

    def broken(*args):
        calls.append(1)
        if len(calls) == 1:
            raise OSError("lost")
        return append(*args)

    append = J._append
    monkeypatch.setattr(J, "_append", broken)
    with pytest.raises(OSError):
        J.write_jsonl_single(frame(2000), path, ("doc_id",))
    assert len(ids()) == 1000
    assert [f for f in os.listdir(tmp_path) if not f.startswith(".")] == ["s.jsonl"]


def test_read_pair(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": "x"}\n')
    got = J.read_pair(spark, str(tmp_path / "a.jsonl"), str(tmp_path / "none.jsonl"))
    assert [(r.side, r.text) for r in got.collect()] == [("input", "x")]


def test_read_lines(spark, tmp_path):
    (tmp_path / "l.txt").write_text("a\nb\nc\n")
    assert J.read_lines(spark, str(tmp_path / "l.txt")).count() == 3


def test_scratch_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert S.scratch_root(spark) == root
    df = S.stage(spark.range(3), "t")
    assert df.count() == 3 and df.inputFiles()[0].removeprefix("file://").startswith(root)


def test_release_deletes_staged_tables_only(spark, tmp_path):
    staged = S.stage(spark.range(3), "gone").inputFiles()[0].removeprefix("file://")
    other = tmp_path / "stays"
    spark.range(3).write.parquet(str(other))
    S.release(spark)
    assert not os.path.exists(staged) and other.exists()


def test_cluster_without_shared_folder_is_refused(spark, monkeypatch):
    class Elsewhere:
        conf = {}

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        S.scratch_root(Elsewhere)


def test_source_by_file(spark, tmp_path):
    from prosemill.operators.ingest import IngestConfig, ingest

    for name in ("a.jsonl", "b.jsonl"):
        (tmp_path / name).write_text('{"text": "%s"}\n' % ("words " * 30 + name[0]))
    raw = J.read_jsonl(spark, str(tmp_path))
    out = ingest(raw, IngestConfig(input_path=str(tmp_path)), source=J.file_name())
    assert sorted(r.source for r in out.collect()) == ["a.jsonl", "b.jsonl"]


def test_run_over_records_without_text(spark, tmp_path):
    cfg = C.from_dict(settings(tmp_path, tokenization={"enabled": False}))
    raw = spark.createDataFrame([("u",)], "url string")
    report = run(spark, cfg, raw)
    assert report.counts == {"ingested": 0, "filtered": 0, "deduplicated": 0}
    assert report.retention_pct is None


def test_output_bytes(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x").write_bytes(b"12345")
    assert S.output_bytes(spark, str(tmp_path / "d")) == 5


def test_spread_only_small_scans(spark):
    assert S.spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == 8
    assert S.spread(spark.range(100, numPartitions=20)).rdd.getNumPartitions() == 20


def test_shuffles_grow_with_the_input(spark):
    mb, gb, tb = 1 << 20, 1 << 30, 1 << 40
    sizes = [S.shuffle_partitions(n) for n in (1, 512 * mb, 100 * gb, 10 * tb, 100 * tb)]
    assert sizes == [1, 2, 400, 20_000, 51_200]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    S.size_shuffles(spark.range(10))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    try:
        S.size_shuffles(spark.range(100, numPartitions=50))  # as many splits as 6 GB
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 25
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
