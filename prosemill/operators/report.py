"""Inspection of an input corpus against its cleaned output.

Reports take a frame with ``side`` (see :func:`prosemill.sources.jsonl.pair`) and give
one row per side, from one scan.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import language, pii, toxicity
from ..functions import patterns as P
from ..functions import text as X

SIDE = "side"


def pct(part: Column, whole: Column) -> Column:
    """part in % of whole, 0 for an empty whole."""
    return F.round(F.coalesce(X.share(part * F.lit(100.0), whole), F.lit(0.0)), 4)


# ------------------------------------------------------------------------- funnel


def stage_funnel(counts: DataFrame, stages) -> DataFrame:
    """One row of stage counts to one row per stage, with its share of the first stage."""
    pairs = ", ".join(f"{i}, '{name}', {name}" for i, name in enumerate(stages))
    return counts.selectExpr("*", f"stack({len(stages)}, {pairs}) AS (step, stage, docs)").select(
        "step", "stage", "docs", pct(F.col("docs"), F.col(stages[0])).alias("pct_of_input"))


def retention(counts: DataFrame, first: str, last: str) -> DataFrame:
    return counts.withColumn("retention_pct", pct(F.col(last), F.col(first)))


# ------------------------------------------------------------------------- lengths


def with_lengths(df: DataFrame) -> DataFrame:
    """Add ``char_count`` and ``word_count``, reusing what the frame has per row."""
    def have(name, fresh):
        return F.coalesce(F.col(name), fresh) if name in df.columns else fresh

    return df.withColumns({
        "char_count": have("char_count", X.char_count(F.col("text"))),
        "word_count": have("word_count", X.word_count(F.col("text")))})


def length_stats(df: DataFrame) -> DataFrame:
    return with_lengths(df).groupBy(SIDE).agg(F.count("*").alias("docs"), *[
        agg.alias(f"{name}_{unit}s")
        for unit in ("char", "word")
        for name, agg in (("mean", F.round(F.avg(f"{unit}_count"), 4)),
                          ("min", F.min(f"{unit}_count")), ("max", F.max(f"{unit}_count")))])


def log_edges(last_power: int, bins: int = 24) -> list[float]:
    """``bins`` + 1 edges, evenly spaced in the exponent from 10 to 10^last_power."""
    return [10.0 ** (1 + (last_power - 1) * i / bins) for i in range(bins)] + [10.0**last_power]


def bin_of(value: Column, edges: list[float]) -> Column:
    """Bin number from 0; -1 below and the number of bins above; bins are left-closed, the
    last one closed. A null counts as below.

    Compared with the edges themselves, so rounding of a logarithm plays no role.
    """
    at_or_above = F.aggregate(
        F.array(*map(F.lit, edges)), F.lit(0), lambda n, edge: n + (value >= edge).cast("int"))
    last = len(edges) - 2
    inside = F.least(at_or_above - 1, F.lit(last))
    return F.when(value > edges[-1], F.lit(last + 1)).when(value >= edges[0], inside).otherwise(F.lit(-1))


def length_histogram_log(df: DataFrame) -> DataFrame:
    """Documents per log-spaced bin: characters 10..10^5, words 10..10^4. Bins of a unit sum
    up to the documents: those outside the range are in the bins before and after it."""
    sized = with_lengths(df).select(SIDE, F.explode(F.array(
        F.struct(F.lit("chars").alias("unit"), bin_of(F.col("char_count"), log_edges(5)).alias("bin")),
        F.struct(F.lit("words").alias("unit"), bin_of(F.col("word_count"), log_edges(4)).alias("bin")),
    )).alias("b"))
    return sized.select(SIDE, "b.unit", F.col("b.bin").cast("bigint").alias("bin")).groupBy(SIDE, "unit", "bin").agg(F.count("*").alias("docs"))


# -------------------------------------------------------------------------- integrity


def integrity_scan(df: DataFrame) -> DataFrame:
    """Documents with left-over tags, code keywords or wide whitespace."""
    text = F.col("text")
    checks = {"html": P.HTML_TAG, "code": P.CODE_KEYWORD, "whitespace": P.WIDE_SPACE}
    counted = df.groupBy(SIDE).agg(
        F.count("*").alias("docs"),
        *[F.count_if(X.contains(text, p)).alias(f"{name}_docs") for name, p in checks.items()])
    return counted.withColumns(
        {f"{name}_pct": pct(F.col(f"{name}_docs"), F.col("docs")) for name in checks})


def uniqueness_check(df: DataFrame, id_col: str = "doc_id", approximate: bool = False) -> DataFrame:
    """Rows, distinct ids, distinct texts and the duplicates among them.

    Texts are compared by their SHA-256 digest, so long texts never shuffle. ``approximate``
    estimates both counts from sketches, with the bound ``error_pct``; no digest is shuffled.
    """
    if approximate:
        from .sketches import uniqueness_report, uniqueness_sketches

        return uniqueness_report(uniqueness_sketches(df, id_col))
    slim = df.select(SIDE, F.col(id_col).alias("id"), F.unhex(F.sha2("text", 256)).alias("digest"))
    return (slim.groupBy(SIDE).agg(
        F.count("*").alias("docs"), F.countDistinct("id").alias("unique_ids"),
        F.countDistinct("digest").alias("unique_texts"))
        .withColumn("duplicate_texts", F.col("docs") - F.col("unique_texts"))
        .withColumn("duplicate_pct", pct(F.col("duplicate_texts"), F.col("docs"))))


# --------------------------------------------------------------------- personal data


def pii_leak_report(df: DataFrame) -> DataFrame:
    """Per side and kind: occurrences, documents affected, both per 100 documents."""
    found = df.select(SIDE, F.explode(F.array(*[
        F.struct(F.lit(kind).alias("kind"), pii.leaks(F.col("text"), kind).alias("n"))
        for kind in pii.KINDS])).alias("leak")).select(SIDE, "leak.*")
    return found.groupBy(SIDE, "kind").agg(
        F.sum("n").alias("occurrences"), F.count_if(F.col("n") > 0).alias("docs_affected"),
        F.count("*").alias("docs"),
    ).withColumns({
        "occurrence_pct": pct(F.col("occurrences"), F.col("docs")),
        "docs_pct": pct(F.col("docs_affected"), F.col("docs"))})


def redaction_tag_count(df: DataFrame) -> DataFrame:
    return df.groupBy(SIDE).agg(F.coalesce(F.sum(pii.tag_count(F.col("text"))), F.lit(0)).alias("tags"))


def redaction_examples(df: DataFrame, order_by: str, chars: int = 300) -> DataFrame:
    """For each side and tag the first document containing it, cut to ``chars``."""
    tags = F.filter(
        F.array(*[F.lit(tag) for _, tag in pii.KINDS.values()]),
        lambda tag: F.contains(F.col("text"), tag))
    return (df.select(SIDE, order_by, F.substring("text", 1, chars).alias("cut"), F.explode(tags).alias("tag"))
            .groupBy(SIDE, "tag").agg(
                F.min(order_by).alias("first_doc"), F.min_by("cut", order_by).alias("example")))


# --------------------------------------------------------------------------- sampling


def sample_docs_random(df: DataFrame, n: int, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """Exactly ``n`` documents (all if there are fewer), the same for the same seed:
    the smallest hashes of seed and id. A distributed top-n, no full sort.
    """
    rank = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return df.orderBy(rank, id_col).limit(n)


# --------------------------------------------------------------------------- toxicity


def toxicity_scores(df: DataFrame, scorer: str = "lexicon", threshold: float = 0.5) -> DataFrame:
    """Documents above the threshold per side and classifier category."""
    scored = df.select(SIDE, toxicity.SCORERS[scorer](F.coalesce(F.col("text"), F.lit(""))).alias("score"))
    long = scored.select(SIDE, F.explode(F.array(*[
        F.struct(F.lit(c).alias("category"), F.col(f"score.{c}").alias("value"))
        for c in P.TOXICITY_CATEGORIES])).alias("s")).select(SIDE, "s.*")
    return long.groupBy(SIDE, "category").agg(
        F.count("*").alias("docs"), F.count_if(F.col("value") > threshold).alias("toxic_docs"),
    ).withColumn("toxic_pct", pct(F.col("toxic_docs"), F.col("docs")))


# --------------------------------------------------------------------------- language


def with_label(df: DataFrame, scorer: str = "stopword", size: int | None = None) -> DataFrame:
    """Add ``lang_label`` without prefix, predicted on the whole text or the first characters."""
    found = language.predict(F.col("text"), scorer, size, "head")
    return df.withColumn("lang_label", language.strip_label(found["label"]))


def language_distribution(df: DataFrame, scorer: str = "stopword") -> DataFrame:
    return with_label(df, scorer).groupBy(SIDE, "lang_label").agg(F.count("*").alias("docs")).orderBy(
        SIDE, F.desc("docs"), "lang_label")


def english_vs_other(df: DataFrame, scorer: str = "stopword") -> DataFrame:
    english = F.count_if(F.col("lang_label") == "en")
    return with_label(df, scorer).groupBy(SIDE).agg(
        english.alias("english"), (F.count("*") - english).alias("other"), F.count("*").alias("total"),
    ).withColumns({
        "english_pct": pct(F.col("english"), F.col("total")),
        "other_pct": pct(F.col("other"), F.col("total"))})
