"""Exact and near-duplicate removal; the first document in an explicit order wins.

A near duplicate is a document that shares an LSH bucket with a *kept* earlier one.
Dropped documents are not indexed, so with A~B and B~C but not A~C, both A and C stay.
With ``verify`` the shared bucket counts only if the shingle sets are similar enough.
That is a greedy choice in document order; :func:`first_wins` computes it in rounds of
aggregations and joins over narrow (document, bucket) rows instead of one by one.
"""

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..functions.minhash import best_bands, lsh_bands, shingle_hashes
from ..sources.storage import stage, stage_bucketed
from .ingest import computed_once
from .joins import hot_keys, join_by_key, join_spread


INGEST_TIME = "ingest_time"


@dataclass(frozen=True)
class DedupConfig:
    enabled: bool = True
    num_perm: int = 128
    threshold: float = 0.85
    ngram_size: int = 5
    seed: int = 42
    family: str = "sha1"
    verify: bool = False  # a bucket hit counts only if the shingle sets are as similar as the threshold

    def __post_init__(self):
        if self.enabled and not 64 <= self.num_perm <= 256:
            warnings.warn(f"num_perm={self.num_perm} is outside the usual range 64-256")
        if self.enabled and not 0.7 <= self.threshold <= 0.95:
            warnings.warn(f"threshold={self.threshold} is outside the usual range 0.7-0.95")

    def bands(self) -> tuple[int, int]:
        return best_bands(self.threshold, self.num_perm)

    def with_buckets(self, df: DataFrame) -> DataFrame:
        """``df`` with the bucket keys of its texts. Python sees hashes only, no text."""
        hashed = computed_once(df, _hashes=shingle_hashes(F.col("text"), self.ngram_size, self.family))
        keys = lsh_bands(*self.bands(), self.num_perm, self.seed, self.family)
        return hashed.withColumn("buckets", keys("_hashes")).drop("_hashes")


# ---------------------------------------------------------------------------- exact


def dedup_exact(df: DataFrame, order_by, id_col: str = "doc_id") -> DataFrame:
    """One row per id: the first in ``order_by`` order; a hash of the remaining columns
    breaks ties, so that no text is a sort key. The time of ingestion is not among them: it
    would let each run keep another copy.

    Each map task already reduces an id to one row (the group limit below the
    shuffle), so an id that holds a third of all rows costs its reducer one row per
    map task. Without the id column the frame passes unchanged.
    """
    if id_col not in df.columns:
        return df
    rest = [c for c in df.columns if c not in {id_col, INGEST_TIME, *order_by} and _orderable(df, c)]
    first = Window.partitionBy(id_col).orderBy(*order_by, F.xxhash64(*rest) if rest else id_col)
    return df.withColumn("_copy", F.row_number().over(first)).where("_copy = 1").drop("_copy")


def _orderable(df: DataFrame, name: str) -> bool:
    return not isinstance(df.schema[name].dataType, (T.MapType, T.VariantType))


# ------------------------------------------------------------------- greedy in rounds


def shared_members(members: DataFrame) -> DataFrame:
    """The rows of ``members`` (distinct document, ``bucket`` pairs, materialised) whose
    bucket has more than one document; materialised. The others can hit nothing.
    """
    counts = stage(members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        return members.limit(0)
    hot = hot_keys(counts, "bucket", "n", total)
    return stage(join_by_key(members, counts.select("bucket"), "bucket", hot, "left_semi"), "conflicts")


def first_wins(members: DataFrame) -> DataFrame:
    """Greedy keep-first over buckets: one ``doc`` per dropped document.

    ``members`` holds distinct (``doc``, ``bucket``) rows, ``doc`` being the unique
    order key, and should be materialised.

    A round keeps every document that is first in all its buckets, drops the others
    in those buckets, and goes on with the rest. It settles at least the first open
    document, so the rounds end; most collections need one or two. With documents in the
    order of a hash a chain of n overlapping documents falls apart into runs of a few, and
    rounds grow about as the logarithm of n; an order that follows a chain costs a round per
    two links. Each round is one written table of both the decided and the open rows.
    """
    dropped = members.select("doc").limit(0)
    while total := members.count():
        marked = stage(_settle_round(members, total), "round")
        dropped = dropped.unionByName(marked.where("not kept").select("doc").distinct())
        members = marked.where("kept IS NULL").drop("kept")
    return dropped


def _settle_round(members: DataFrame, total: int) -> DataFrame:
    """The members with ``kept``: true or false for documents that a round decides, else null."""
    heads = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("doc").alias("first"))
    degree = members.groupBy("doc").agg(F.count("*").alias("degree"))
    wins = heads.groupBy(F.col("first").alias("doc")).agg(F.count("*").alias("wins"))
    kept = wins.join(degree, "doc").where("wins = degree").select("doc")
    # a bucket is closed once its first document is kept: the others are near copies
    closed = heads.join(kept, F.col("first") == F.col("doc"), "left_semi").select("bucket", "first")
    decided = join_by_key(members, closed, "bucket", hot_keys(heads, "bucket", "n", total))
    decided = decided.groupBy("doc").agg(F.max(F.col("doc") == F.col("first")).alias("kept"))
    return members.join(decided, "doc", "left").select("doc", "bucket", "kept")


# ------------------------------------------------------------------- verified edges


def shingle_sets(df: DataFrame, docs: DataFrame, cfg: DedupConfig, id_col: str) -> DataFrame:
    """Materialised ``doc``, ``hashes`` (distinct 64-bit hashes of the shingles) of some documents.
    ``docs`` has the order key ``doc`` of each; of all others only the id is looked at."""
    keyed = docs.select("doc", _id_of(docs, id_col).alias("_id")).hint("merge")
    texts = df.select(F.col(id_col).alias("_id"), "text").join(keyed, "_id")
    return stage(texts.select("doc", F.transform(X.shingles(F.col("text"), cfg.ngram_size), lambda g: F.xxhash64(g)).alias("hashes")), "sets")


def _id_of(docs: DataFrame, id_col: str):
    return F.col(f"doc.{id_col}") if isinstance(docs.schema["doc"].dataType, T.StructType) else F.col("doc")


def with_jaccard(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Add ``jaccard`` of the shingle sets to materialised, distinct pairs (``a``, ``b``); a
    document with many pairs is spread over tasks."""
    both = join_spread(pairs, sets.select(F.col("doc").alias("a"), F.col("hashes").alias("_x")), "a")
    both = both.join(sets.select(F.col("doc").alias("b"), F.col("hashes").alias("_y")).hint("merge"), "b")
    common = computed_once(both, _common=F.size(F.array_intersect("_x", "_y")))
    return common.select(*pairs.columns, (F.col("_common") / (F.size("_x") + F.size("_y") - F.col("_common"))).alias("jaccard"))


#: first members of a bucket that a round compares with the others: twice as many each round, up to this
MOST_HUBS = 64


def first_verified_wins(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Greedy keep-first where only bucket hits of at least the threshold count: one ``doc`` per
    dropped document. As :func:`first_wins`, but a bucket may hold several kept documents.

    In a round the first open members of each bucket are its hubs: every later member is
    compared with them, once, and they leave the bucket. A document is kept when all earlier
    members of its buckets have been hubs and none that is similar is kept or open, and dropped
    when a similar earlier one is kept; dropped ones leave all buckets. Pairs are formed with hubs
    only: near copies are one pair each, as their hub is kept in the first round. The number of
    hubs doubles, so that buckets of many documents that are not similar need few rounds.

    The smallest open document is decided in each round, so the rounds end.
    """
    members = members.select("doc", "bucket")
    open_ = stage(members.select("doc").distinct(), "open")
    kept = dropped = open_.limit(0)
    edges = None
    hubs_each = 1
    while open_.head(1):
        first = Window.partitionBy("bucket").orderBy("doc")
        hubs = stage(members.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= hubs_each).select("bucket", "doc"), "hubs")
        lists = hubs.groupBy("bucket").agg(F.sort_array(F.collect_list("doc")).alias("hubs"))
        counts = stage(members.groupBy("bucket").agg(F.count("*").alias("n")), "buckets")
        hot = hot_keys(counts, "bucket", "n", counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
        pairs = join_by_key(members, lists, "bucket", hot).select(F.explode("hubs").alias("a"), F.col("doc").alias("b")).where("a < b")
        pairs = stage(pairs.distinct(), "pairs")
        found = with_jaccard(pairs, sets).where(F.col("jaccard") >= threshold).select("a", "b")
        edges = stage(found if edges is None else edges.union(found), "edges")
        members = members.join(hubs, ["bucket", "doc"], "left_anti")

        now = F.col("b").alias("doc")
        gone = edges.join(kept.withColumnRenamed("doc", "a"), "a", "left_semi").select(now)
        heads = members.groupBy("bucket").agg(F.min("doc").alias("head"))
        blocked = join_by_key(members, heads, "bucket", hot).where("head < doc").select("doc")
        waiting = edges.join(open_.withColumnRenamed("doc", "a"), "a", "left_semi").select(now)
        fresh = stage(open_.join(gone.union(blocked).union(waiting).distinct(), "doc", "left_anti"), "kept")
        more = edges.join(fresh.withColumnRenamed("doc", "a"), "a", "left_semi").select(now)
        lost = stage(gone.union(more).distinct().join(open_, "doc", "left_semi"), "lost")
        kept, dropped = kept.union(fresh), dropped.union(lost)
        open_ = stage(open_.join(fresh.union(lost), "doc", "left_anti"), "open")
        members = stage(members.join(lost, "doc", "left_anti"), "members")
        edges = stage(edges.join(lost.withColumnRenamed("doc", "b"), "b", "left_anti").join(
            lost.withColumnRenamed("doc", "a"), "a", "left_anti").select("a", "b"), "edges")
        hubs_each = min(2 * hubs_each, MOST_HUBS)
    return dropped


def kept_match(conflicts: DataFrame, dropped: DataFrame) -> DataFrame:
    """For every dropped ``doc`` the first kept document with a common bucket (``kept_doc``).

    A bucket has at most one kept document, so this is linear in the members: no
    pairs inside a bucket are ever formed.
    """
    dropped = stage(dropped, "dropped")
    holders = conflicts.join(dropped, "doc", "left_anti").select("bucket", F.col("doc").alias("kept_doc"))
    losers = conflicts.join(dropped, "doc", "left_semi")
    counts = stage(losers.groupBy("bucket").agg(F.count("*").alias("n")), "buckets")
    found = join_by_key(losers, holders, "bucket", hot_keys(counts, "bucket", "n", conflicts.count()))
    return found.groupBy("doc").agg(F.min("kept_doc").alias("kept_doc"))


# ---------------------------------------------------------------------------- fuzzy


def order_key(order_by, id_col: str) -> F.Column:
    """The total order of documents as one column; a plain one if the id alone orders."""
    cols = list(dict.fromkeys([*order_by, id_col]))
    return F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)


def band_table(df: DataFrame, order_by, cfg: DedupConfig, id_col: str = "doc_id") -> DataFrame:
    """Materialised id, order columns and ``buckets``, one narrow row per document."""
    names = dict.fromkeys([*order_by, id_col])
    return stage(cfg.with_buckets(df.select(*dict.fromkeys([*names, "text"]))).select(*names, "buckets"), "bands")


def conflicts_of(bands: DataFrame, order_by, id_col: str) -> DataFrame:
    """Materialised (``doc``, ``bucket``) rows of buckets with several documents.

    Only ids and bucket keys take part in finding them; the order columns join in
    afterwards, for the few documents that share a bucket.
    """
    members = bands.select(F.col(id_col).alias("doc"), F.explode("buckets").alias("bucket"))
    conflicts = shared_members(members)
    if list(dict.fromkeys([*order_by, id_col])) == [id_col]:
        return conflicts
    keys = bands.select(F.col(id_col).alias("id"), order_key(order_by, id_col).alias("doc"))
    return stage(conflicts.withColumnRenamed("doc", "id").join(keys, "id").select("doc", "bucket"), "keyed")


def _dropped(bands: DataFrame, order_by, id_col: str, cfg: DedupConfig, texts: DataFrame) -> DataFrame:
    conflicts = conflicts_of(bands, order_by, id_col)
    if not cfg.verify:
        return first_wins(conflicts)
    return first_verified_wins(conflicts, shingle_sets(texts, conflicts.select("doc").distinct(), cfg, id_col), cfg.threshold)


def _without(df: DataFrame, dropped: DataFrame, order_by, id_col: str) -> DataFrame:
    plain = list(dict.fromkeys([*order_by, id_col])) == [id_col]
    ids = dropped.select(F.col("doc" if plain else f"doc.{id_col}").alias(id_col))
    return df.join(ids, id_col, "left_anti").select(*df.columns)


def dedup_fuzzy(df: DataFrame, order_by, cfg: DedupConfig = DedupConfig(), id_col: str = "doc_id") -> DataFrame:
    """Without near duplicates. Ids must be unique; run :func:`dedup_exact` before.

    The frame is evaluated twice (signatures, result), so pass a table, not a long
    plan. Without ``text`` it passes unchanged.
    """
    if "text" not in df.columns:
        return df
    bands = band_table(df, order_by, cfg, id_col)
    return _without(df, _dropped(bands, order_by, id_col, cfg, df), order_by, id_col)


def near_dup_matches(df: DataFrame, order_by, cfg: DedupConfig = DedupConfig(), id_col: str = "doc_id") -> DataFrame:
    """Each dropped document with the first kept one it collides with, and how similar they are:
    ``doc``, ``kept_doc``, ``jaccard`` of their shingle sets. One pair per dropped document is
    formed and compared. The rule is the bucket hit, whatever ``cfg.verify`` says.
    """
    conflicts = conflicts_of(band_table(df, order_by, cfg, id_col), order_by, id_col)
    matches = stage(kept_match(conflicts, first_wins(conflicts)).select(F.col("kept_doc").alias("a"), F.col("doc").alias("b")), "matches")
    docs = matches.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    return with_jaccard(matches, shingle_sets(df, docs, cfg, id_col)).select(F.col("b").alias("doc"), F.col("a").alias("kept_doc"), "jaccard")


def dedup(df: DataFrame, order_by, cfg: DedupConfig = DedupConfig(), id_col: str = "doc_id") -> DataFrame:
    """Exact, then fuzzy. The survivors of the first step are written once, together with
    their bucket keys and bucketed by the id as they lie; the rounds read only the narrow
    columns, and the last join moves only ids. So texts are shuffled once.
    """
    if not cfg.enabled:
        return df
    unique = dedup_exact(df, order_by, id_col)
    if not {"text", id_col} <= set(df.columns):
        return unique
    unique = stage_bucketed(cfg.with_buckets(unique), id_col, "unique")
    return _without(unique.drop("buckets"), _dropped(unique, order_by, id_col, cfg, unique), order_by, id_col)
