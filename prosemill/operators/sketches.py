"""Report figures from mergeable sketches, kept per run and merged across runs.

A KLL sketch answers quantiles of a measure, a theta sketch counts distinct ids and texts and how
many of them two sides share. Sketches are a few kilobytes each, whatever they have seen; those
of later runs are merged with the ones kept, and nothing old is read again. The exact reports in
:mod:`prosemill.operators.report` stay the default.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .report import SIDE, pct

#: size of a KLL sketch, and the binary logarithm of the hashes that a theta sketch holds
KLL_K, THETA_LG = 800, 14


def rank_error(k: int = KLL_K) -> float:
    """How far the rank of an answered quantile is from the one asked for, as a share of all
    values, with a probability of 99 %: the bound that the KLL sketch is published with."""
    return 2.296 / k**0.9723


def count_error(lg: int = THETA_LG, deviations: float = 3.0) -> float:
    """Relative error of a theta count at so many standard deviations; none below 2**lg values."""
    return deviations / 2 ** (lg / 2)


# ------------------------------------------------------------------------------- quantiles


def quantile_sketches(df: DataFrame, measures: dict[str, Column], by: str = SIDE, k: int = KLL_K) -> DataFrame:
    """``by, measure, docs, n, total, least, most, sketch`` of each measure; NaN and null values
    are counted in ``docs`` only. All measures come from one scan."""
    each = df.select(by, *(F.nanvl(m.cast("double"), F.lit(None).cast("double")).alias(name) for name, m in measures.items()))
    aggs = [F.struct(F.lit(name).alias("measure"), F.count("*").alias("docs"), F.count(name).alias("n"), F.sum(name).alias("total"), F.min(name).alias("least"),
                     F.max(name).alias("most"), F.kll_sketch_agg_double(F.col(name), F.lit(k)).alias("sketch")).alias(f"_{name}") for name in measures]
    return each.groupBy(by).agg(*aggs).select(by, F.inline(F.array(*(f"_{name}" for name in measures))))


def merge_quantiles(sketches: DataFrame, by: str = SIDE) -> DataFrame:
    """One row per ``by`` and measure from any number of rows."""
    return sketches.groupBy(by, "measure").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"),
        F.max("most").alias("most"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantile_report(sketches: DataFrame, shares=(0.25, 0.5, 0.75, 0.95, 0.99), by: str = SIDE, k: int = KLL_K) -> DataFrame:
    """Counts, mean, least, most and quantiles ``p25 ...`` of merged sketches, with the bound of
    their ranks; null for a measure without values."""
    some = F.col("n") > 0
    return sketches.select(
        by, "measure", "docs", "n", F.try_divide("total", "n").alias("mean"), "least", "most",
        *(F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).alias(f"p{round(100 * p)}") for p in shares),
        F.lit(rank_error(k)).alias("rank_error"))


# -------------------------------------------------------------------------- distinct counts


def uniqueness_sketches(df: DataFrame, id_col: str = "doc_id", by: str = SIDE, lg: int = THETA_LG) -> DataFrame:
    """``by, docs, ids, texts``: theta sketches of the ids and of the texts' digests."""
    digest = F.sha2(F.col("text"), 256)
    return df.select(by, F.col(id_col).cast("string").alias("id"), digest.alias("digest")).groupBy(by).agg(
        F.count("*").alias("docs"), F.theta_sketch_agg("id", F.lit(lg)).alias("ids"), F.theta_sketch_agg("digest", F.lit(lg)).alias("texts"))


def merge_uniqueness(sketches: DataFrame, by: str = SIDE, lg: int = THETA_LG) -> DataFrame:
    return sketches.groupBy(by).agg(
        F.sum("docs").alias("docs"), *(F.theta_union_agg(c, F.lit(lg)).alias(c) for c in ("ids", "texts")))


def uniqueness_report(sketches: DataFrame, by: str = SIDE, lg: int = THETA_LG) -> DataFrame:
    """As :func:`prosemill.operators.report.uniqueness_check`, estimated, with ``error_pct``."""
    texts = F.theta_sketch_estimate("texts")
    # an estimate may exceed the number of rows
    unique = F.least(texts, F.col("docs"))
    return sketches.select(
        by, "docs", F.least(F.theta_sketch_estimate("ids"), F.col("docs")).alias("unique_ids"), unique.alias("unique_texts"),
        (F.col("docs") - unique).alias("duplicate_texts"), pct(F.col("docs") - unique, F.col("docs")).alias("duplicate_pct"),
        F.lit(round(100 * count_error(lg), 4)).alias("error_pct"))


def shared_report(sketches: DataFrame, first: str, second: str, by: str = SIDE) -> DataFrame:
    """How many texts and ids two sides share, and how many only the first has: one row, from
    one row of sketches per side. A side that is missing shares nothing."""
    def only(side, c):
        return F.max(F.when(F.col(by) == side, F.col(c)))

    # both sides in one row, without a join
    row = sketches.groupBy().agg(*(only(side, c).alias(f"{c}_{k}") for k, side in enumerate((first, second)) for c in ("ids", "texts")))

    def count(fn, c):
        return F.coalesce(F.theta_sketch_estimate(fn(f"{c}_0", f"{c}_1")), F.lit(0)).cast("bigint")

    return row.select(
        count(F.theta_intersection, "ids").alias("shared_ids"), count(F.theta_intersection, "texts").alias("shared_texts"),
        count(F.theta_difference, "texts").alias("only_first"))


# -------------------------------------------------------------------------- kept across runs


def keep_sketches(sketches: DataFrame, path: str, run: str) -> None:
    """Add the sketches of a run to those kept at a path; a run that is there is replaced."""
    if not run or "/" in run:
        raise ValueError(f"{run!r} cannot name a run")
    sketches.write.mode("overwrite").parquet(f"{path}/run={run}")


def kept_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The sketches of all runs at a path, one row each; merge them for a report."""
    return spark.read.parquet(path)
