"""Connected components of an edge table by alternating star contractions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import stage


def _star(pairs: DataFrame) -> DataFrame:
    """(u, v) with v < u -> every v and u points at the least neighbour of u."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    inner = pairs.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return inner.union(least.select("u", F.col("m").alias("v")))


def _large(pairs: DataFrame) -> DataFrame:
    """Every larger neighbour of u points at the least of u and its neighbours."""
    both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge; root is the least node reachable.

    Union-find as joins: each round contracts every neighbourhood to its least node, with
    no list of neighbours in any task, and is written to the shared scratch folder. Nodes
    may be of any ordered type. Edges with a null end and loops say nothing and are left
    out; an empty table gives an empty one.
    """
    now = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "edges")
    state = None
    while True:
        facts = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if facts == state or facts[0] == 0:
            roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
        state = facts
        now = stage(_star(_large(now).distinct()).distinct(), "edges")
