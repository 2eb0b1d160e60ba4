"""Queries of reports from sketches. Quantiles are random within their bound, so they are shown as
whether the exact rank of the answer is inside it."""

from pyspark.sql import functions as F

from ..operators import sketches as K
from ..operators.report import uniqueness_check
from ..sources.storage import scratch_path, stage
from . import oracle_sql as S
from .registry import documents, query
from .report_queries import _LINES, _PERPLEXITY, _scores, lines
from .row_queries import SIDES_SQL, sides

_SHARES = (0.25, 0.5, 0.75, 0.95)
_INSIDE = ", ".join(f"true AS p{round(100 * p)}_inside" for p in _SHARES)


def _ranked(report, values, error):
    """The report with, for each quantile, whether its rank among the exact values is in bounds."""
    pairs = report.select("side", "measure", F.explode(F.array(*(F.struct(F.lit(p).alias("share"), F.col(f"p{round(100 * p)}").alias("value")) for p in _SHARES))).alias("q"))
    asked = pairs.groupBy("side", "measure").agg(F.collect_list("q").alias("qs"))  # one row per side and measure
    found = values.join(F.broadcast(asked), ["side", "measure"]).where("value IS NOT NULL").select("side", "measure", "value", F.explode("qs").alias("q"))
    ranks = found.groupBy("side", "measure", "q").agg(
        F.count_if(F.col("value") < F.col("q.value")).alias("under"), F.count_if(F.col("value") <= F.col("q.value")).alias("upto"), F.count("*").alias("all"))
    off = F.greatest(F.col("under") / F.col("all") - F.col("q.share"), F.col("q.share") - F.col("upto") / F.col("all"), F.lit(0.0))
    inside = ranks.select("side", "measure", F.col("q.share").alias("share"), (off <= error).alias("inside"))
    wide = inside.groupBy("side", "measure").agg(*(F.max(F.when(F.col("share") == p, F.col("inside"))).alias(f"p{round(100 * p)}_inside") for p in _SHARES))
    return report.join(F.broadcast(wide), ["side", "measure"]).select(
        "side", "measure", "docs", F.round("mean", 4).alias("mean"), "least", "most", *(f"p{round(100 * p)}_inside" for p in _SHARES))


def _long(df, measures):
    return df.select("side", F.explode(F.array(*(F.struct(F.lit(n).alias("measure"), c.cast("double").alias("value")) for n, c in measures.items()))).alias("m")).select("side", "m.*")


_SIZES = {"chars": F.length, "bytes": F.octet_length}


@query("doc_size_sketch", f"""
    SELECT 'all' AS side, measure, count(*) AS docs, round(avg(v), 4) AS mean, min(v) AS least, max(v) AS most, {_INSIDE} FROM (
    SELECT 'chars' AS measure, length(value)::double AS v FROM {_LINES} UNION ALL SELECT 'bytes', strlen(value)::double FROM {_LINES}) GROUP BY measure""")
def doc_size_sketch(spark, sf_dir):
    """Line sizes of a raw corpus; the exact values are read to check the quantiles only."""
    rows = lines(spark, sf_dir).withColumn("side", F.lit("all"))
    measures = {name: fn(F.col("value")) for name, fn in _SIZES.items()}
    report = stage(K.quantile_report(K.quantile_sketches(rows, measures), _SHARES), "report")
    return _ranked(report, _long(rows, measures), K.rank_error())


@query("length_sketch_merged", f"""
    SELECT side, measure, count(*) AS docs, round(avg(v), 4) AS mean, min(v) AS least, max(v) AS most, {_INSIDE} FROM (
    SELECT side, 'chars' AS measure, length(text)::double AS v FROM {SIDES_SQL} UNION ALL SELECT side, 'words', {S.words('text')}::double FROM {SIDES_SQL})
    GROUP BY side, measure""")
def length_sketch_merged(spark, sf_dir):
    """Lengths from the sketches of three runs, kept in files and merged."""
    from ..functions.text import char_count, word_count

    rows, path = sides(spark, sf_dir), scratch_path(spark, "sketches")
    measures = {"chars": char_count(F.col("text")), "words": word_count(F.col("text"))}
    for run in range(3):
        K.keep_sketches(K.quantile_sketches(rows.where(F.pmod(F.hash("doc_id"), F.lit(3)) == run), measures), path, str(run))
    merged = K.merge_quantiles(K.kept_sketches(spark, path))
    return _ranked(stage(K.quantile_report(merged, _SHARES), "report"), _long(rows, measures), K.rank_error())


@query("perplexity_sketch", f"""{_PERPLEXITY}
    SELECT 'input' AS side, 'perplexity' AS measure, count(*) AS docs, round(avg(perplexity), 4) AS mean, round(min(perplexity), 4) AS least,
        round(max(perplexity), 4) AS most, {_INSIDE} FROM documents LEFT JOIN scores USING (doc_id)""")
def perplexity_sketch(spark, sf_dir):
    """Perplexities from a sketch; documents without a score count as such only."""
    scores = stage(_scores(spark, sf_dir), "scores")
    measures = {"perplexity": F.col("perplexity")}
    report = stage(K.quantile_report(K.quantile_sketches(scores, measures), _SHARES), "report")
    values = _long(scores.where("NOT isnan(perplexity)"), measures)
    return _ranked(report, values, K.rank_error()).withColumns({c: F.round(c, 4) for c in ("least", "most")})


@query("uniqueness_approx", f"""
    SELECT side, count(*) AS docs, count(DISTINCT doc_id) AS unique_ids, count(DISTINCT text) AS unique_texts,
           count(*) - count(DISTINCT text) AS duplicate_texts,
           round((count(*) - count(DISTINCT text)) * 100.0::double / count(*), 4) AS duplicate_pct, 2.3438::double AS error_pct
    FROM {SIDES_SQL} GROUP BY side""")
def uniqueness_approx(spark, sf_dir):
    """Estimated; exact as long as a side has fewer distinct values than a sketch holds hashes."""
    return uniqueness_check(sides(spark, sf_dir), approximate=True)


@query("uniqueness_inside", f"SELECT side, true AS ids_inside, true AS texts_inside FROM {SIDES_SQL} GROUP BY side")
def uniqueness_inside(spark, sf_dir):
    """Whether sketches of 1,024 hashes keep to their bound, merged from the halves of a corpus."""
    lg, rows = 10, sides(spark, sf_dir)
    halves = [K.uniqueness_sketches(rows.where(F.pmod(F.hash("doc_id"), F.lit(2)) == k), lg=lg) for k in (0, 1)]
    found = K.uniqueness_report(K.merge_uniqueness(halves[0].unionByName(halves[1]), lg=lg), lg=lg)
    exact = uniqueness_check(rows).select("side", F.col("unique_ids").alias("i"), F.col("unique_texts").alias("t"))

    def inside(name, of):
        return F.abs(F.col(name) - F.col(of)) <= F.col(of) * F.col("error_pct") / 100

    return found.join(exact.hint("merge"), "side").select("side", inside("unique_ids", "i").alias("ids_inside"), inside("unique_texts", "t").alias("texts_inside"))


@query("shared_texts", f"""
    SELECT (SELECT count(DISTINCT doc_id) FROM documents WHERE lang = 'en') AS shared_ids,
        (SELECT count(DISTINCT text) FROM documents WHERE text IN (SELECT text FROM documents WHERE lang = 'en')) AS shared_texts,
        (SELECT count(DISTINCT text) FROM documents WHERE text NOT IN (SELECT text FROM documents WHERE lang = 'en')) AS only_first""")
def shared_texts(spark, sf_dir):
    """What all documents and the English ones have in common, from a sketch of each."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    both = docs.withColumn("side", F.lit("input")).unionByName(docs.where("lang = 'en'").withColumn("side", F.lit("output")))
    return K.shared_report(K.uniqueness_sketches(both), "input", "output")
