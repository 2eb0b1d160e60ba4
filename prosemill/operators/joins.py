"""Joins and selections that stay balanced when one key holds most rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: a key is hot above 1/HOT_SLICES of all rows, so there are fewer than HOT_SLICES hot keys
HOT_SLICES = 5_000
#: the same for narrow rows, of a term and a few numbers (some 100 bytes each when broadcast)
BROADCAST_TERMS = 200_000


def hot_keys(counts: DataFrame, key: str, n: str, total: int, slices: int = HOT_SLICES) -> DataFrame:
    """Keys with more than ``total / slices`` rows.

    ``counts`` has one row per key and its row count ``n``; the counts sum up to at
    most ``total``, so fewer than ``slices`` keys qualify: safe to broadcast.
    """
    return counts.where(F.col(n) * F.lit(slices) > F.lit(total)).select(key)


def join_by_key(left: DataFrame, right: DataFrame, key: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """Join ``left`` (many rows per key) to ``right`` (one row per key).

    Rows of hot keys never shuffle: their right rows, at most one per hot key, are
    broadcast. All other keys are small enough for any partition of a shuffle join.
    ``how`` is ``inner``, ``left`` or ``left_semi``.
    """
    hot = F.broadcast(hot.select(key))
    of_hot = left.join(hot, key, "left_semi").join(
        F.broadcast(right.join(hot, key, "left_semi")), key, how)
    of_rest = left.join(hot, key, "left_anti").join(right, key, how)
    return of_hot.unionByName(of_rest)


def join_spread(left: DataFrame, right: DataFrame, key: str, most: int = 10_000) -> DataFrame:
    """Join ``left`` (many rows per key, materialised) to wide rows of ``right`` (one per key).

    A key with more than ``most`` rows on the left gets as many copies of its right row as
    there are ``most`` rows, so no task takes more than about ``most`` of them, and nothing is
    broadcast whose size is not known.
    """
    copies = left.groupBy(key).agg(F.ceil(F.count("*") / most).cast("int").alias("_copies"))
    salted = right.join(copies.hint("merge"), key).select(*right.columns, F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("_salt"))
    rest = [c for c in left.columns if c != key]
    left = left.join(copies.where("_copies > 1").hint("merge"), key, "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(*rest), "_copies").cast("int"), F.lit(0)) if rest else F.lit(0))
    return left.drop("_copies").join(salted.hint("merge"), [key, "_salt"]).drop("_salt")


def join_salted(left: DataFrame, right: DataFrame, key: str, counts: DataFrame, total: int, how: str = "inner") -> DataFrame:
    """As :func:`join_by_key` with one shuffle, for a ``left`` that is costly to evaluate twice.

    ``counts`` has the number ``n`` of left rows of each key, ``total`` in all. The right row of a
    hot key is copied as often as 1/HOT_SLICES of all rows go into its own; the left rows are
    dealt out over the copies.
    """
    hot = counts.where(F.col("n") * F.lit(HOT_SLICES) > F.lit(total)).select(
        key, F.ceil(F.col("n") * F.lit(HOT_SLICES) / F.lit(max(total, 1))).cast("int").alias("_copies"))
    rest = [c for c in left.columns if c != key]
    dealt = left.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(*rest), "_copies").cast("int"), F.lit(0)) if rest else F.lit(0)).drop("_copies")
    copied = right.join(F.broadcast(hot), key, "left").select(
        *right.columns, F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)).alias("_salt"))
    return dealt.join(copied.hint("merge"), [key, "_salt"], how).drop("_salt")


def term_sums(terms: DataFrame, table: DataFrame, key: str, counts: DataFrame, total: int, small: bool, **sums) -> DataFrame:
    """``id, rows`` and sums per id over rows (``id``, a term under ``key``, ``rows``), where a sum
    reads ``_n``, how many of the term there are, and the columns that ``table`` has for the
    term, null for others and for a null term.

    A ``small`` table is broadcast. Of a larger one the rows of frequent terms are, with more than
    1/BROADCAST_TERMS of ``total`` in ``counts`` (the term and ``n``), so fewer than BROADCAST_TERMS. One pass
    over the terms sums these up where they are; only the distinct rare terms of an id are shuffled.
    """
    totals = [F.sum(c).alias(c) for c in ("rows", *sums)]
    if small:
        near = terms.join(F.broadcast(table), key, "left").withColumn("_n", F.lit(1).cast("bigint"))
        return near.select("id", "rows", *(c.alias(name) for name, c in sums.items())).groupBy("id").agg(*totals)
    hot = hot_keys(counts, key, "n", total, BROADCAST_TERMS)
    near = terms.join(F.broadcast(table.join(F.broadcast(hot), key, "left_semi").withColumn("_hot", F.lit(True))), key, "left")
    near = near.withColumn("_n", F.lit(1).cast("bigint"))
    known = F.col("_hot").isNotNull() | F.col(key).isNull()
    # a null term stands for all that is summed up already
    far = near.groupBy("id", F.when(~known, F.col(key)).alias(key)).agg(
        F.sum("rows").alias("rows"), F.count_if(~known).alias("_n"), *(F.sum(F.when(known, c)).alias(name) for name, c in sums.items()))
    # behind the generator, so that both parts read one shuffle
    far = far.select(F.inline(F.array(F.struct(*far.columns))))
    rare = far.where(F.col(key).isNotNull()).select("id", key, "rows", "_n").join(table, key, "left")
    rare = rare.select("id", "rows", *(c.alias(name) for name, c in sums.items()))
    return far.where(F.col(key).isNull()).select("id", "rows", *sums).unionByName(rare).groupBy("id").agg(*totals)


def int_median(df: DataFrame, by: str, value: str, step: float = 4096) -> DataFrame:
    """Exact median of a numeric column per group, in two levels.

    Values are counted first; a cumulative count over blocks of ``step`` values finds
    the block of each middle rank, and a second one inside that block the value. No
    task sees more than the blocks of one group or ``step`` values.
    """
    from pyspark.sql import Window

    counts = df.where(F.col(value).isNotNull()).groupBy(by, F.col(value).alias("v")).agg(
        F.count("*").alias("n")).withColumn("block", F.floor(F.col("v") / step))
    blocks = counts.groupBy(by, "block").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(by).orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    # half0/half1: ranks (from 1) of the two middle rows, equal for an odd count
    ranked = (
        blocks.withColumn("end", F.sum("n").over(upto))
        .withColumn("total", F.sum("n").over(Window.partitionBy(by)))
        .withColumn("rank", F.explode(F.array(
            F.floor((F.col("total") + 1) / 2), F.floor((F.col("total") + 2) / 2))))
        .where((F.col("rank") <= F.col("end")) & (F.col("rank") > F.col("end") - F.col("n")))
        .select(by, "block", "rank", (F.col("end") - F.col("n")).alias("before"))
    )
    # the two ranks may be equal: number them to keep both
    ranked = ranked.withColumn("half", F.row_number().over(Window.partitionBy(by).orderBy("rank")))
    inside = Window.partitionBy(by, "half").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    picked = (
        counts.join(ranked, [by, "block"])
        .withColumn("end", F.col("before") + F.sum("n").over(inside))
        .where((F.col("rank") <= F.col("end")) & (F.col("rank") > F.col("end") - F.col("n")))
    )
    return picked.groupBy(by).agg(F.avg("v").alias("median"))
