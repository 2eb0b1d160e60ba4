"""Trained language identification: naive Bayes over character n-grams, counted and scored by Spark.

A model is a table of n-grams with one count per language, kept as Parquet with a range of
hashes per partition, and a small table of languages. A document's score for a language is the
log prior plus the log share of each of its n-grams in the language, with add-k smoothing.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.language import LABEL_PREFIX, UNKNOWN
from .ingest import computed_once
from .joins import hot_keys, join_by_key, term_sums

#: a model of up to so many n-grams is broadcast (some 100 bytes each); a larger one is joined by shuffles
BROADCAST_GRAMS = 200_000
#: languages at most; each is a number in every row of the model
MOST_LANGUAGES = 1_000


def plain_text(text: Column) -> Column:
    """Lower-case letters with single blanks between words and at both ends; empty without letters."""
    words = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))
    return F.when(F.length(words) > 0, F.concat(F.lit(" "), words, F.lit(" "))).otherwise("")


def with_grams(df: DataFrame, text: Column, size: int) -> DataFrame:
    """A row for each n-gram of the whole text, one for a text without: ``pos`` and ``gram``, then null."""
    # one match for each character, which looks ahead at the n-gram that begins there
    grams = F.regexp_extract_all(plain_text(F.coalesce(text, F.lit(""))), F.lit(f"(?s)(?=(.{{{size}}}))."), F.lit(1))
    return df.select(*df.columns, F.posexplode_outer(grams).alias("pos", "gram"))


@dataclass(frozen=True)
class LanguageModel:
    """``grams``: (gram, counts), counts in the order of ``languages``; ``totals`` n-grams and
    ``docs`` documents per language; ``vocabulary``: number of distinct n-grams."""

    grams: DataFrame
    languages: tuple[str, ...]
    totals: tuple[int, ...]
    docs: tuple[int, ...]
    size: int
    vocabulary: int

    def losses(self, counts: Column, k: float) -> Column:
        """Log share of an n-gram in each language from its counts."""
        below = F.array(*(F.lit(float(t + k * max(self.vocabulary, 1))) for t in self.totals))
        return F.zip_with(counts, below, lambda n, total: F.log((n + F.lit(k)) / total))

    def priors(self) -> list[float]:
        from math import log

        return [log(n / sum(self.docs)) for n in self.docs]


def gram_counts(df: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = 3) -> DataFrame:
    """``lang, gram, n`` over all rows with a language; counted on the map side first."""
    known = df.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    return with_grams(known, F.col("text"), size).where("gram IS NOT NULL").groupBy("lang", "gram").agg(F.count("*").alias("n"))


def train_language_model(df: DataFrame, path: str, lang_col: str = "lang", text_col: str = "text", size: int = 3) -> LanguageModel:
    """Count the n-grams of all rows with a language, write the model below ``path`` and load it.

    Rows with a null language are not learned from; a language whose texts have no letter is no
    language of the model, as it would win every n-gram that the others lack. An earlier model
    at ``path`` is replaced.
    """
    spark = df.sparkSession
    docs = df.where(F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("docs"))
    names = [r.lang for r in docs.orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in {lang_col}")
    # one entry per language, so the list of a gram is short
    held = F.map_from_entries(F.collect_list(F.struct("lang", "n")))
    counts = gram_counts(df, lang_col, text_col, size).groupBy("gram").agg(held.alias("held")).select("gram", F.transform(
        F.array(*map(F.lit, names)).cast("array<string>"), lambda x: F.coalesce(F.try_element_at("held", x), F.lit(0)).cast("bigint")).alias("counts"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts.repartitionByRange(parts, F.xxhash64("gram")).sortWithinPartitions(F.xxhash64("gram")).write.mode("overwrite").parquet(f"{path}/grams")
    grams = spark.read.schema("gram string, counts array<bigint>").parquet(f"{path}/grams")
    totals = grams.agg(*(F.coalesce(F.sum(F.get("counts", i)), F.lit(0)).alias(f"t{i}") for i in range(len(names))),
                       F.count("*").alias("vocabulary")).first()
    seen = [name for i, name in enumerate(names) if totals[i]]
    if len(seen) < len(names):
        return train_language_model(df.where(F.col(lang_col).isin(seen)), path, lang_col, text_col, size)
    rows = [(i, name, totals[i], size, totals["vocabulary"]) for i, name in enumerate(names)]
    facts = spark.createDataFrame(rows, "place int, lang string, grams bigint, size int, vocabulary bigint")
    facts.join(F.broadcast(docs), "lang").write.mode("overwrite").parquet(f"{path}/languages")
    return load_language_model(spark, path)


def load_language_model(spark: SparkSession, path: str) -> LanguageModel:
    facts = spark.read.parquet(f"{path}/languages").orderBy("place").collect()
    grams = spark.read.schema("gram string, counts array<bigint>").parquet(f"{path}/grams")
    return LanguageModel(grams, tuple(r.lang for r in facts), tuple(r.grams for r in facts), tuple(r.docs for r in facts),
                         facts[0]["size"] if facts else 3, facts[0]["vocabulary"] if facts else 0)


def predict_language(df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", k: float = 0.5,
                     broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """``id, label, score, rows``: per id the best language of the whole text, as ``__label__xx``,
    and its posterior probability; ``rows`` counts the rows of an id.

    Ties go to the first language by name. A text that is null or has no letter, and any text
    without a model, is unknown with score 0. Ids name texts: rows that repeat an id are one
    document, whose score is that of a single copy, and null ids are one id.

    A model of up to ``broadcast_grams`` n-grams is broadcast, and each task sums up its own
    documents. Of a larger one the n-grams that are frequent in the model are broadcast, and only
    the others of a document are joined by shuffles.
    """
    languages = range(len(model.languages))
    docs = with_grams(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), F.col("text"), model.size)
    # a row of the input counts by its first n-gram, or by the null of a text without any
    docs = docs.select("id", "gram", F.when(F.coalesce("pos", F.lit(0)) == 0, 1).otherwise(0).alias("rows"))
    table = model.grams.select("gram", model.losses(F.col("counts"), k).alias("losses"))
    every = model.grams.select("gram", F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n"))
    seen = F.when(F.col("gram").isNotNull(), F.col("_n")).otherwise(0)
    unseen = [F.log(F.lit(k / (t + k * max(model.vocabulary, 1)))) for t in model.totals]
    sums = {f"s{i}": seen * F.coalesce(F.get("losses", i), unseen[i]) for i in languages}
    scored = term_sums(docs, table, "gram", every, sum(model.totals), model.vocabulary <= broadcast_grams, grams=seen, **sums)
    if not model.languages:
        return scored.select(F.col("id").alias(id_col), F.lit(UNKNOWN[0]).alias("label"), F.lit(UNKNOWN[1]).alias("score"), "rows")
    values = F.array(*(F.col(f"s{i}") / F.col("rows") + F.lit(p) for i, p in zip(languages, model.priors())))
    scored = computed_once(scored.withColumn("values", values), best=F.array_max("values"))
    total = F.aggregate(F.col("values"), F.lit(0.0), lambda a, v: a + F.exp(v - F.col("best")))
    label = F.concat(F.lit(LABEL_PREFIX), F.get(F.array(*map(F.lit, model.languages)), F.array_position("values", F.col("best")).cast("int") - 1))
    known = F.col("grams") > 0
    return scored.select(
        F.col("id").alias(id_col), F.when(known, label).otherwise(UNKNOWN[0]).alias("label"),
        F.when(known, 1 / total).otherwise(UNKNOWN[1]).alias("score"), "rows")


def filter_language(df: DataFrame, model: LanguageModel, target: str, min_score: float, id_col: str = "doc_id",
                    text_col: str = "text", **options) -> DataFrame:
    """The rows whose language is ``target`` with a score strictly above the minimum. Rows of an
    id that holds a large part of all rows are not shuffled. Null ids go."""
    found = predict_language(df, model, id_col, text_col, **options)
    passing = found.where((F.col("label") == target) & (F.col("score") > min_score) & F.col(id_col).isNotNull())
    total = df.count()
    return join_by_key(df, passing.select(id_col), id_col, hot_keys(passing, id_col, "rows", total), "left_semi").select(*df.columns)
