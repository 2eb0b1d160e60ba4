"""Perplexity over sliding windows, with a bigram model counted by Spark.

A document is cut into windows of ``context`` tokens that start every ``stride``
tokens; a window scores only the tokens that no earlier window covered, and the last
window is the first one that reaches the end. A document's perplexity is the
exponential of the mean of its window losses.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import batch_scorer, scorer_registry
from ..sources.storage import stage
from .ingest import computed_once
from .joins import hot_keys, int_median, join_by_key

#: fewer frequent bigrams than this are broadcast, of two numbers each
BROADCAST_BIGRAMS = 1_000_000
#: room for a dictionary of two million words in a Parquet file, whose rows then hold their numbers
_WORD_PAGES = {"parquet.dictionary.page.size": 16 << 20}


@dataclass(frozen=True)
class Windows:
    context: int = 1024
    stride: int = 512

    def __post_init__(self):
        if not 0 < self.stride <= self.context:
            raise ValueError("need 0 < stride <= context")

    def count(self, tokens: Column) -> Column:
        """Number of windows of a document with so many tokens."""
        more = F.ceil((tokens - self.context) / self.stride)
        return F.when(tokens <= 0, 0).when(tokens <= self.context, 1).otherwise(1 + more).cast("int")

    def of(self, position: Column) -> Column:
        """The window that scores a token position (from 0)."""
        later = 1 + F.floor((position - self.context) / self.stride)
        return F.when(position < self.context, 0).otherwise(later).cast("int")


def words(text: Column) -> Column:
    """Whitespace tokens; an empty array for a blank text."""
    return F.array_remove(F.split(text, r"(?U)\s+"), "")


def perplexity_windows(df: DataFrame, windows: Windows = Windows(), id_col: str = "doc_id") -> DataFrame:
    """The window table: ``begin, end, target_len`` (tokens newly covered)."""
    sized = df.select(id_col, F.size(words(F.col("text"))).alias("tokens"))
    w = F.col("window")
    end = F.least(w * windows.stride + windows.context, F.col("tokens"))
    before = F.when(w == 0, 0).otherwise((w - 1) * windows.stride + windows.context)
    return (
        sized.withColumn("n", windows.count(F.col("tokens"))).where("n > 0")
        .select(id_col, "tokens", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("window"))
        .select(id_col, *[c.cast("bigint").alias(name) for name, c in (
            ("window", w), ("begin", w * windows.stride), ("end", end), ("target_len", end - before))]))


# ---------------------------------------------------------------------- bigram model


def bigrams(df: DataFrame, windows: Windows, id_col: str) -> DataFrame:
    """``doc, window, first, second, gram, n``: how often a bigram is scored in a window of a
    document, counted inside the row of the document, so that nothing is shuffled for it.

    Words are their 64-bit hashes, and so is the bigram. The first word of a document has neither
    predecessor nor window and is not scored; it comes as a row of its own.
    """
    def entry(i):
        return F.struct(windows.of(i).alias("window"), F.get("ids", i - 1).alias("first"), F.get("ids", i).alias("second"))

    last = F.size("ids") - 1
    rows = df.select(F.col(id_col).alias("doc"), F.transform(words(F.col("text")), lambda x: F.xxhash64(x)).alias("ids"))
    rows = computed_once(rows, ids=F.col("ids")).where("size(ids) > 0")
    pairs = F.when(last > 0, F.sort_array(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), entry)))
    rows = computed_once(rows, pairs=pairs)
    # runs of equal entries: where each begins, and how far the next one is
    begins = F.filter(F.sequence(F.lit(0), F.size("pairs") - 1), lambda i: (i == 0) | (F.get("pairs", i) != F.get("pairs", i - 1)))
    rows = computed_once(rows, begins=F.when(F.size("pairs") > 0, begins))
    runs = F.transform("begins", lambda at, k: F.struct(
        F.get("pairs", at).alias("pair"), (F.coalesce(F.get("begins", k + 1), F.size("pairs")) - at).cast("bigint").alias("n")))
    lone = F.struct(F.struct(F.lit(None).cast("int").alias("window"), F.lit(None).cast("bigint").alias("first"), F.get("ids", F.lit(0)).alias("second")).alias("pair"),
                    F.lit(1).cast("bigint").alias("n"))
    return rows.select("doc", F.explode(F.array_append(F.coalesce(runs, F.array().cast(
        "array<struct<pair:struct<window:int,first:bigint,second:bigint>,n:bigint>>")), lone)).alias("run")).select(
        "doc", "run.pair.*", F.xxhash64("run.pair.first", "run.pair.second").alias("gram"), "run.n")


def bigram_model(pairs: DataFrame, k: float) -> DataFrame:
    """``gram, n, loss`` with add-k smoothing from staged bigrams. Counting combines on the map
    side; every word is the second of some row, so the vocabulary comes from the counts."""
    counts = stage(pairs.groupBy("first", "second").agg(F.sum("n").alias("n")), "grams")
    vocabulary = counts.select("second").distinct().count()
    grams = counts.where("first IS NOT NULL")
    contexts = stage(grams.groupBy("first").agg(
        F.sum("n").alias("first_n"), F.count("*").alias("grams")), "contexts")
    total = contexts.agg(F.coalesce(F.sum("grams"), F.lit(0))).first()[0]
    known = join_by_key(grams, contexts.drop("grams"), "first", hot_keys(contexts, "first", "grams", total))
    smooth = (F.col("n") + k) / (F.col("first_n") + k * vocabulary)
    return known.select(F.xxhash64("first", "second").alias("gram"), "n", (-F.log(smooth)).alias("loss"))


def perplexity(
    df: DataFrame, windows: Windows = Windows(), k: float = 0.1, weighted: bool = False,
    scored: DataFrame | None = None, id_col: str = "doc_id",
) -> DataFrame:
    """``id, windows, perplexity`` of each document under a bigram model of ``df``.

    ``scored`` names the documents to score, a part of ``df``; the model always sees
    all. A document with nothing to score has a NaN perplexity. ``weighted`` weighs
    windows by their scored tokens; without it a short last window counts like a full
    one. Texts are cut into words once; model, vocabulary and scores read the staged bigrams,
    one row for each that is distinct in a window. Bigrams are joined by 64 bits, so among
    billions of distinct ones a few share a count.
    """
    # the hash of a bigram follows from its words, and is the one column that Parquet cannot make smaller
    pairs = stage(bigrams(df, windows, id_col).drop("gram"), "pairs", **_WORD_PAGES).withColumn("gram", F.xxhash64("first", "second"))
    model = stage(bigram_model(pairs, k), "model")
    docs = df if scored is None else df.join(scored.select(id_col), id_col, "left_semi")
    own = pairs if scored is None else pairs.join(scored.select(F.col(id_col).alias("doc")), "doc", "left_semi")
    total = model.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # every bigram is in the model; a left join keeps the many rows of the left side,
    # whose size the optimizer underestimates, from being broadcast
    losses = join_by_key(
        own.where("window IS NOT NULL").select("doc", "window", "gram", "n"), model.select("gram", "loss"), "gram",
        hot_keys(model, "gram", "n", total, BROADCAST_BIGRAMS), "left")
    by_window = losses.groupBy("doc", "window").agg(F.sum(F.col("n") * F.col("loss")).alias("loss"), F.sum("n").alias("tokens"))
    mean = F.sum("loss") / F.sum("tokens") if weighted else F.avg(F.col("loss") / F.col("tokens"))
    by_doc = by_window.groupBy("doc").agg(F.count("*").alias("windows"), mean.alias("mean_loss"))
    return docs.select(F.col(id_col).alias("doc")).join(by_doc, "doc", "left").select(
        F.col("doc").alias(id_col), F.coalesce("windows", F.lit(0)).alias("windows"),
        F.coalesce(F.exp("mean_loss"), F.lit(float("nan"))).alias("perplexity"))


def model_perplexity(load, predict, batch_size: int = 8):
    """Scorer around an external language model: ``predict(model, texts)`` returns one
    perplexity per text; ``load`` runs once per Python worker."""
    def rows(model, texts):
        return [(float(value),) for value in predict(model, texts)]

    return batch_scorer(load, rows, "perplexity double", batch_size=batch_size)


#: name -> (text -> struct<perplexity>) for external models
SCORERS = scorer_registry()


def perplexity_stats(scores: DataFrame, by: str = "side") -> DataFrame:
    """Documents, unscored ones among them, mean and exact median of the scores. The median
    is found in two levels of counts, so no task holds the values of a group."""
    value = F.when(~F.isnan("perplexity"), F.col("perplexity"))
    facts = scores.groupBy(by).agg(
        F.count("*").alias("docs"), F.count_if(value.isNull()).alias("unscored"), F.avg(value).alias("mean"))
    middle = int_median(scores.select(by, value.alias("value")), by, "value", step=1 / 64)
    # both as rows of one table, merged by the key: a join would need no key if it is a constant
    rows = facts.withColumn("median", F.lit(None).cast("double")).unionByName(middle, allowMissingColumns=True)
    return rows.groupBy(by).agg(*(F.max(c).alias(c) for c in ("docs", "unscored", "mean", "median")))


def perplexity_histogram(scores: DataFrame, by: str = "side", bins: int = 49, top: float = 500.0) -> DataFrame:
    """Documents per linear bin on [0, top]; the last bin includes its right edge. Bin
    ``bins`` holds those above, bin -1 unscored ones, so bins sum up to the documents."""
    value = F.col("perplexity")
    bin_no = (F.when(F.isnan(value) | value.isNull(), -1).when(value == top, bins - 1).when(value > top, bins)
              .otherwise(F.width_bucket(value, F.lit(0.0), F.lit(top), F.lit(bins)) - 1))
    return scores.groupBy(by, bin_no.cast("bigint").alias("bin")).agg(F.count("*").alias("docs"))
