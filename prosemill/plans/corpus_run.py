"""A whole run: ingest, filter, deduplicate, export, tokenize, report."""

import argparse
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import dedup
from ..operators.ingest import ingest
from ..operators.quality import TRAINED, quality_filter
from ..operators.tokenize import run_tokenization
from ..sources.jsonl import CORRUPT, export_columns, read_jsonl, write_jsonl, write_jsonl_single
from ..sources.session import ship_package
from ..sources.storage import output_bytes, release, size_shuffles, spread, stage
from .config import RunConfig, load_config


@dataclass
class RunReport:
    documents: DataFrame
    counts: dict = field(default_factory=dict)
    output_path: str | None = None
    output_mb: float | None = None
    tokens_path: str | None = None
    token_anomalies: dict = field(default_factory=dict)

    @property
    def retention_pct(self) -> float | None:
        first, last = self.counts.get("ingested"), self.counts.get("deduplicated")
        return 100.0 * last / first if first and last is not None else None


def prepare(raw: DataFrame, cfg: RunConfig, counts: dict | None = None) -> DataFrame:
    """Raw records to deduplicated documents, materialised once.

    ``counts`` receives the number of documents after each step, and of malformed lines
    where ``raw`` has them marked. These are observed while the one writing job runs;
    nothing is computed again to count it.
    """
    size_shuffles(raw)
    raw = spread(raw)
    watch = {}

    def observed(df: DataFrame, name: str) -> DataFrame:
        if counts is None:
            return df
        watch[name] = Observation(name)
        return df.observe(watch[name], F.count(F.lit(1)).alias("n"))

    if CORRUPT in raw.columns:
        bad = F.col(CORRUPT).isNotNull()
        if cfg.fail_on_malformed:
            text = F.when(bad, F.raise_error(F.concat(F.lit("malformed line: "), CORRUPT))).otherwise(F.col("text"))
            raw = raw.withColumn("text", text)
        elif counts is not None:
            watch["malformed"] = Observation("malformed")
            raw = raw.observe(watch["malformed"], F.count_if(bad).alias("n"))
        raw = raw.drop(CORRUPT)
    docs = observed(ingest(raw, cfg.ingestion), "ingested")
    if cfg.filtering.enabled:
        if cfg.filtering.language_scorer == TRAINED:
            docs = stage(docs, "ingested")  # the model is joined to it
        docs = observed(quality_filter(docs, cfg.filtering), "filtered")
    if cfg.deduplication.enabled:
        docs = stage(dedup(docs, list(cfg.order_by), cfg.deduplication), "documents")
    else:
        docs = stage(docs, "documents")
    if counts is not None:
        counts.update({name: o.get["n"] for name, o in watch.items()})
        if cfg.deduplication.enabled:
            counts["deduplicated"] = docs.count()
    return docs


def run(spark: SparkSession, cfg: RunConfig, raw: DataFrame | None = None) -> RunReport:
    """Execute all enabled steps; any failure raises. ``raw`` replaces the input file.

    The staged tables stay for ``report.documents``; ``release`` deletes them.
    """
    ship_package(spark)
    if raw is None:
        raw = read_jsonl(spark, cfg.ingestion.input_path, with_corrupt=True)
    counts = {} if cfg.compute_counts else None
    report = RunReport(prepare(raw, cfg, counts), counts or {})

    export = export_columns(report.documents)
    if cfg.single_file:
        report.output_path = write_jsonl_single(export, cfg.output_file, order_by=("doc_id",))
    else:
        write_jsonl(export, cfg.output_file)
        report.output_path = cfg.output_file
    report.output_mb = output_bytes(spark, report.output_path) / 1024**2

    if cfg.tokenization.enabled:
        metrics = Observation("tokens")
        report.tokens_path = run_tokenization(
            report.documents, cfg.tokenization, cfg.processed_dir, metrics)
        report.token_anomalies = dict(metrics.get)
    return report


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description="Prepare a text corpus with Spark")
    parser.add_argument("--config", required=True, help="YAML configuration file")
    cfg = load_config(parser.parse_args(argv).config)
    spark = SparkSession.builder.appName("prosemill").getOrCreate()
    report = run(spark, cfg)
    print(json.dumps({
        "counts": report.counts, "retention_pct": report.retention_pct, "output": report.output_path,
        "output_mb": report.output_mb, "tokens": report.tokens_path, "anomalies": report.token_anomalies,
    }))
    release(spark)


if __name__ == "__main__":
    main()
