"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR: folder of the tables; BENCH_CPUS: local cores.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "clean_text", "ingest", "quality_filter", "dedup_exact", "dedup_fuzzy_sha1", "tokenize",
    "write_jsonl_sharded", "write_tokens_parquet", "corpus_run",
    "profile_corpus", "length_histogram_log", "integrity_scan", "pii_leak_report",
    "language_distribution", "uniqueness_check", "perplexity_stats",
)


def whole_run(spark, sf_dir):
    """Seconds from JSON lines to cleaned JSON lines and token Parquet, with counts."""
    from prosemill.operators.tokenize import TokenizeConfig
    from prosemill.plans.config import RunConfig
    from prosemill.plans.corpus_queries import RUN, _ranks
    from prosemill.plans.corpus_run import run
    from prosemill.sources.jsonl import read_jsonl, write_jsonl
    from prosemill.sources.storage import scratch_path

    if _ranks() is None:
        raise FileNotFoundError("the run includes tokenization, and there is no rank file")
    raw, out, tokens = (scratch_path(spark, name) for name in ("raw", "out", "tokens"))
    write_jsonl(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text"), raw)
    cfg = RunConfig(
        ingestion=RUN.ingestion, filtering=RUN.filtering, output_file=out, processed_dir=tokens,
        tokenization=TokenizeConfig(ranks_path=_ranks()))
    start = time.perf_counter()
    run(spark, cfg, read_jsonl(spark, raw))
    return round(time.perf_counter() - start, 3)


def main():
    from pyspark.sql import SparkSession

    from prosemill.plans.catalog import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # start the JVM and the Python workers outside the measurement
    QUERIES["html_unescape"](spark, sf_dir).limit(10).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    times["whole_run"] = whole_run(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    print(json.dumps({
        "metric": "total_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus), "documents": docs,
        "whole_run_docs_per_sec": round(docs / times["whole_run"], 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
