"""Toxicity learned from labelled documents, and hits of lexicons of any size.

The learned score is that of a multinomial model: the log odds of the labels plus those of each
word of the text. A large lexicon is a table: documents find their own words in it by a join,
and only the places of those words are compared with its terms.
"""

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..sources.storage import stage
from .ingest import computed_once
from .joins import hot_keys, join_by_key, join_salted, term_sums
from .report import SIDE, pct

#: a table of up to so many words or terms is broadcast (some 50 bytes each)
BROADCAST_WORDS = 200_000
#: steps of the score at which precision and recall are counted
STEPS = 100


def tokens(text: Column) -> Column:
    """Lower-case runs of letters, digits and underscores."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_]+"), "")


# -------------------------------------------------------------------------- learned model


@dataclass(frozen=True)
class ToxicityModel:
    """``words``: (word, toxic, clean) counts; totals of both, and documents of both labels."""

    words: DataFrame
    toxic: int
    clean: int
    toxic_docs: int
    clean_docs: int
    vocabulary: int

    def odds(self, k: float = 1.0) -> Column:
        """Log odds of a word being one of a toxic text, with add-k smoothing."""
        def share(name, total):
            return F.log((F.col(name) + F.lit(k)) / F.lit(total + k * self.vocabulary))

        return share("toxic", self.toxic) - share("clean", self.clean)


def train_toxicity_model(docs: DataFrame, labels: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                         label_col: str = "toxic") -> ToxicityModel | None:
    """Count the words of documents by their label, write the model below ``path`` and load it.

    Labels other than 0 and 1, and null ids, say nothing. None without documents of both labels.
    """
    told = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(told, "id")
    each = known.select("label", F.explode_outer(tokens(F.col("text"))).alias("word"))
    counts = each.where("word IS NOT NULL").groupBy("word").agg(
        F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("clean"))
    counts.repartition(F.xxhash64("word")).write.mode("overwrite").parquet(f"{path}/words")
    known.groupBy().agg(F.count_if(F.col("label") == 1).alias("toxic_docs"), F.count_if(F.col("label") == 0).alias("clean_docs")).write.mode(
        "overwrite").parquet(f"{path}/docs")
    return load_toxicity_model(docs.sparkSession, path)


def load_toxicity_model(spark: SparkSession, path: str) -> ToxicityModel | None:
    words = spark.read.schema("word string, toxic bigint, clean bigint").parquet(f"{path}/words")
    sums = words.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("toxic", "clean")), F.count("*")).first()
    docs = spark.read.parquet(f"{path}/docs").select("toxic_docs", "clean_docs").first()
    return ToxicityModel(words, sums[0], sums[1], docs[0], docs[1], sums[2]) if all(docs) else None


def score_toxicity(df: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", k: float = 1.0,
                   broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """``id, logit, score`` of each id: log odds of being toxic over the whole text, and the
    probability they stand for.

    Words that the model lacks say nothing, so a text without known words has the odds of the
    labels. Rows that repeat an id count as one document; null ids are one id.
    """
    docs = df.select(F.col(id_col).alias("id"), F.posexplode_outer(tokens(F.col(text_col))).alias("pos", "word"))
    docs = docs.select("id", "word", F.when(F.coalesce("pos", F.lit(0)) == 0, 1).otherwise(0).alias("rows"))
    counts = model.words.select("word", (F.col("toxic") + F.col("clean")).alias("n"))
    found = term_sums(docs, model.words.select("word", model.odds(k).alias("odds")), "word", counts, model.toxic + model.clean,
                      model.vocabulary <= broadcast_words, odds=F.coalesce(F.col("_n") * F.col("odds"), F.lit(0.0)))
    logit = F.col("odds") / F.col("rows") + F.lit(log(model.toxic_docs / model.clean_docs))
    return found.select("id", logit.alias("logit")).select(
        F.col("id").alias(id_col), "logit", (1 / (1 + F.exp(-F.greatest(F.least("logit", F.lit(700.0)), F.lit(-700.0))))).alias("score"))


def toxicity_report(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Documents above the threshold per side and category. Labels tell toxicity as such only,
    so the counts of the other categories are null, not 0."""
    counted = scores.groupBy(SIDE).agg(F.count("*").alias("docs"), F.count_if(F.col("score") > threshold).alias("n"))
    each = F.explode(F.array(*map(F.lit, P.TOXICITY_CATEGORIES))).alias("category")
    known = F.col("category") == P.TOXICITY_CATEGORIES[0]
    return counted.select(SIDE, each, "docs", "n").select(
        SIDE, "category", "docs", F.when(known, F.col("n")).alias("toxic_docs"), F.when(known, pct(F.col("n"), F.col("docs"))).alias("toxic_pct"))


def score_sweep(scores: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", steps: int = STEPS) -> DataFrame:
    """Precision and recall at each threshold: ``step, threshold, predicted, hits, toxic, precision,
    recall``, for scores of at least step/steps against the labels.

    Scores are counted by step first; a step's count then goes to each threshold below it, so
    the cumulative sums are sums over at most ``steps`` squared rows.
    """
    told = labels.where(F.col(label_col).isin(0, 1)).select(id_col, (F.col(label_col) == 1).cast("bigint").alias("toxic"))
    step = F.least(F.floor(F.col("score") * steps), F.lit(steps - 1)).cast("int")
    counts = scores.select(id_col, step.alias("step")).join(told, id_col).groupBy("step").agg(F.count("*").alias("n"), F.sum("toxic").alias("hits"))
    upto = counts.select(F.explode(F.sequence(F.lit(0), "step")).alias("step"), "n", "hits").groupBy("step").agg(
        F.sum("n").alias("predicted"), F.sum("hits").alias("hits"))
    every = F.col("most.toxic")
    # the lowest threshold has all toxic rows; it comes to the others as a row of theirs
    whole = upto.where("step = 0").select(F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("step"), F.struct(F.col("hits").alias("toxic")).alias("most"))
    return upto.join(whole, "step").select(
        F.col("step").cast("bigint").alias("step"), (F.col("step") / F.lit(float(steps))).alias("threshold"), "predicted", "hits", every.alias("toxic"),
        F.round(F.col("hits") / F.col("predicted"), 6).alias("precision"), F.round(F.try_divide("hits", every), 6).alias("recall"))


# --------------------------------------------------------------------------- large lexicons


def term_index(lexicon: DataFrame, term_col: str = "term", rank_col: str | None = None) -> DataFrame:
    """``head, terms``: terms by their first word, each with its ``rank``, words, and what stands
    between them. A term has to begin and end with a letter, digit or underscore; others are an
    error. ``rank_col`` orders terms as an alternation would; longer ones come first without it.
    """
    term = F.lower(F.col(term_col))
    good = F.when(~F.col("term").rlike(r"(?s)^[\p{L}\p{N}_](.*[\p{L}\p{N}_])?$"),
                  F.raise_error(F.concat(F.lit("a term has to begin and end with a word character: "), "term"))).otherwise(F.col("term"))
    rank = F.min(rank_col) if rank_col else F.min(-F.length(term))
    rows = lexicon.where(term != "").groupBy(term.alias("term")).agg(rank.cast("bigint").alias("rank")).withColumn("term", good)
    pieces = rows.select("rank", tokens(F.col("term")).alias("words"), _gaps("term").alias("gaps"))
    return pieces.groupBy(F.get("words", F.lit(0)).alias("head")).agg(F.collect_list(F.struct("rank", "words", "gaps")).alias("terms"))


def _gaps(text: str) -> Column:
    """What stands between the words of a text: one more than words, the ends included."""
    return F.split(F.lower(F.col(text)), r"[\p{L}\p{N}_]+")


def word_places(docs: DataFrame) -> DataFrame:
    """``id, head, at``: a row for each distinct word of a text, with its places in ascending order.

    Words are sorted inside the row, so the work grows with the words of a text and their
    logarithm, however many of them a lexicon has.
    """
    rows = computed_once(docs.select("id", tokens(F.col("text")).alias("words")), words=F.col("words")).where("size(words) > 0")
    rows = computed_once(rows, words=F.sort_array(F.transform("words", lambda w, i: F.struct(w.alias("head"), i.alias("at")))))
    begins = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: (i == 0) | (
        F.get("words", i)["head"] != F.get("words", i - 1)["head"]))
    rows = computed_once(rows, begins=begins)
    runs = F.transform("begins", lambda b, k: F.struct(F.get("words", b)["head"].alias("head"), F.slice(
        "words", b + 1, F.coalesce(F.get("begins", k + 1), F.size("words")) - b)["at"].alias("at")))
    return rows.select("id", F.inline(runs))


def lexicon_hits(df: DataFrame, lexicon: DataFrame, id_col: str = "doc_id", text_col: str = "text", term_col: str = "term",
                 rank_col: str | None = None, broadcast_terms: int = BROADCAST_WORDS) -> DataFrame:
    """``id, hits`` of each id: whole-word matches of a table of terms, in any case.

    They are the matches of the alternation of all terms in the order of ``rank_col`` between word
    boundaries: from left to right, none overlapping another. No pattern is built. Words of a
    document that begin no term are left behind by the first join, and the places of the others
    come out of it, so no text is searched for them again; up to ``broadcast_terms`` first
    words are broadcast, beyond that words that many documents have. Null texts and an empty
    lexicon have no hits. Rows that repeat an id have to repeat its text.
    """
    index = term_index(lexicon, term_col, rank_col)
    index = stage(index, "terms")
    facts = index.agg(F.count("*"), F.max(F.expr("array_max(transform(terms, t -> size(t.words)))"))).first()
    longest = facts[1] or 1
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    own = word_places(docs)
    heads = index.select("head")
    if facts[0] <= broadcast_terms:
        found = own.join(F.broadcast(heads), "head")
    else:
        words = docs.select(F.explode(F.array_distinct(tokens(F.col("text")))).alias("head")).groupBy("head").agg(F.count("*").alias("n"))
        counts = stage(words.join(heads.hint("merge"), "head"), "heads")
        found = join_salted(own, heads, "head", counts, counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    # of rows that repeat an id, places are looked up in each text; words there that begin no term find none
    listed = found.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"))
    every = docs.select("id").distinct()
    if longest == 1:
        # each place is a match, and none overlaps another
        out = every.join(listed.select("id", F.size("at").alias("hits")), "id", "left")
        return out.select(F.col("id").alias(id_col), F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits"))
    held = docs.join(listed.hint("merge"), "id").select("id", "at", F.lower("text").alias("text"))
    held = computed_once(held, words=tokens(F.col("text")), gaps=_gaps("text")).drop("text")
    # the gap after word i is number i + 1
    places = held.select("id", F.explode(F.transform("at", lambda i: F.struct(
        i.alias("at"), F.get("words", i).alias("head"), F.slice("words", i + 1, longest).alias("words"),
        F.slice("gaps", i + 2, longest).alias("gaps")))).alias("p")).select("id", "p.*")
    places = stage(places, "places")
    counts = stage(places.groupBy("head").agg(F.count("*").alias("n")), "heads")
    hot = hot_keys(counts, "head", "n", counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    tried = join_by_key(places, index, "head", hot)

    def fits(t):
        size = F.size(t["words"])
        return (F.slice("words", 1, size) == t["words"]) & (F.slice("gaps", 1, size - 1) == F.slice(t["gaps"], 2, size - 1))

    best = F.array_min(F.transform(F.filter("terms", fits), lambda t: F.struct(t["rank"].alias("rank"), F.size(t["words"]).alias("size"))))
    met = tried.select("id", "at", best.alias("best")).where("best IS NOT NULL").select("id", F.struct("at", (F.col("at") + F.col("best.size")).alias("end")).alias("m"))
    # a match counts if it begins where the last one that counts has ended
    walked = F.aggregate(F.sort_array(F.collect_set("m")), F.struct(F.lit(0).alias("until"), F.lit(0).cast("bigint").alias("n")), lambda s, m: F.when(
        m["at"] >= s["until"], F.struct(m["end"].alias("until"), (s["n"] + 1).alias("n"))).otherwise(s))
    hits = met.groupBy("id").agg(walked["n"].alias("hits"))
    out = every.join(hits, "id", "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits"))
