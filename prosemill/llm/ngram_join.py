"""Similarity join of documents on word shingles by vertical partitioning.

The shingles of all documents have one global order, that of their hashes; it is cut into
fragments. Each fragment sees only its own slice of every document, so counts of shared
shingles and overlaps of pairs are partial, and are summed per document or pair:

1. *Who can have a partner at all.* Of a set of n shingles at most n/5 may be missing from
   a partner, so of its first n/5 + k shingles in the global order at least k lie among the
   first ones of the partner. Fragments count which of these occur in another set.
   Sets that fall short of k leave; in most corpora that is nearly all of them.
2. *Candidates.* The remaining sets order their shingles by frequency. Two similar sets
   share one among the rarest fifth. In the bucket of such a shingle every set meets the
   hub (the set with the fewest shingles of its own); after that, only sets of different
   components meet, and bounds on size and position leave out hopeless pairs. Sets that
   are already connected never form pairs.
3. *Verification.* Candidate pairs are joined with both slices in each fragment; partial
   overlaps are summed per pair.

Equal sets are one class from the first step on, so copies cost one set.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import stage
from .components import components
from .registry import query, table
from .shingles import mix, shingle_sets

#: rows of postings that a task gathers before it sends them
_GATHER = 2_000_000
_LONG = "bigint"


def _tenth(n):
    return np.maximum(1, -(-n // 10))


def _lead(n: int) -> int:
    """How many shingles a set of n sends: a fifth, and the tenth that must be shared."""
    return min(n, n - -(-4 * n // 5) + int(_tenth(n)))


def _need(n):
    """How many of them the smallest possible partner would share at least."""
    return _tenth(-(-4 * n // 5))


def _fingerprint(grams: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, signed; independent of how it is stored."""
    a = mix(np.array([grams.sum(dtype=np.uint64) ^ np.uint64(len(grams))], np.uint64))[0]
    b = mix(np.array([mix(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)], np.uint64))[0]
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _send(gathered, fragments: int):
    """Postings of one block of documents -> rows per fragment.

    Shingles of several sets in this block are known to be shared: their sets are counted
    here, and only the shingle itself is sent, once. So a shingle of a third of all
    documents costs one posting per block.
    """
    prints, grams = zip(*gathered, strict=True)
    owner = np.repeat(np.array(prints, np.int64), [len(g) for g in grams])
    grams = np.concatenate(grams)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    first = np.ones(len(grams), bool)
    first[1:] = grams[1:] != grams[:-1]
    start = np.flatnonzero(first)
    count = np.diff(np.append(start, len(grams)))
    several = np.repeat(count > 1, count)
    known, times = np.unique(owner[several], return_counts=True)
    grams, owner = grams[start], np.where(count > 1, 0, owner[start])
    part = (grams >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)
    cut = np.searchsorted(part, np.arange(fragments + 1, dtype=np.uint64))
    for f in range(fragments):
        a, b = cut[f], cut[f + 1]
        if a < b:
            yield f, grams[a:b].tobytes(), owner[a:b].tobytes()
    for f, a in enumerate(range(0, len(known), 1 << 14)):
        pairs = np.stack([known[a:a + (1 << 14)], times[a:a + (1 << 14)]])
        yield f % fragments, None, pairs.tobytes()


_SENT = pa.schema([("part", pa.int32()), ("grams", pa.binary()), ("owners", pa.binary()),
                   ("id", pa.int64()), ("n", pa.int64()), ("p", pa.int64()), ("q", pa.int64()), ("h", pa.int64())])
_SENT_SQL = "part int, grams binary, owners binary, id bigint, n bigint, p bigint, q bigint, h bigint"


def _map_side(fragments: int, width: int):
    def run(batches):
        gathered, size, seen = [], 0, set()
        for batch in batches:
            docs = []
            for row, grams in shingle_sets(batch.column(1), width):
                p, q = _fingerprint(grams)
                docs.append((len(grams), p, q))
                if len(grams) and p not in seen:
                    seen.add(p)
                    gathered.append((p, grams[:_lead(len(grams))].copy()))
                    size += len(gathered[-1][1])
            n, p, q = (pa.array(x, pa.int64()) for x in zip(*docs, strict=True)) if docs else (pa.array([], pa.int64()),) * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.random.default_rng(len(docs)).integers(0, fragments, len(docs)), pa.int32()),
                 pa.nulls(len(docs), pa.binary()), pa.nulls(len(docs), pa.binary()),
                 batch.column(0), n, p, q, batch.column(2)], schema=_SENT)
            if size > _GATHER:
                yield from _rows(gathered, fragments)
                gathered, size, seen = [], 0, set()
        if gathered:
            yield from _rows(gathered, fragments)

    return run


def _rows(gathered, fragments):
    rows = list(_send(gathered, fragments))
    part, grams, owners = zip(*rows, strict=True)
    none = pa.nulls(len(rows), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(grams, pa.binary()), pa.array(owners, pa.binary()),
         none, none, none, none, none], schema=_SENT)


_TALLY = "id bigint, n bigint, p bigint, q bigint, h bigint, shared bigint"


def _fragment(t: pa.Table) -> pa.Table:
    """One fragment: which of its shingles occur in several sets, counted per set."""
    docs = t.filter(pc.is_null(t["owners"]))
    posts = t.filter(pc.is_valid(t["grams"]))
    known = t.filter(pc.and_(pc.is_null(t["grams"]), pc.is_valid(t["owners"])))
    sets, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for blob in known["owners"].to_pylist():
        a, b = np.frombuffer(blob, np.int64).reshape(2, -1)
        sets.append(a)
        counts.append(b)
    if posts.num_rows:
        grams = np.frombuffer(b"".join(posts["grams"].to_pylist()), np.uint64)
        owner = np.frombuffer(b"".join(posts["owners"].to_pylist()), np.int64)
        order = np.lexsort((owner, grams))
        grams, owner = grams[order], owner[order]
        same = grams[1:] == grams[:-1]
        fresh = np.ones(len(grams), bool)
        fresh[1:] = ~(same & (owner[1:] == owner[:-1]))
        begin = np.flatnonzero(np.concatenate([[True], ~same]))
        group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(grams))))
        # owner 0 stands for several sets of one block
        weight = np.add.reduceat(np.where(fresh, 1 + (owner == 0), 0), begin)
        hit = fresh & (owner != 0) & (weight[group] > 1)
        a, b = np.unique(owner[hit], return_counts=True)
        sets.append(a)
        counts.append(b)
    sets, counts = np.concatenate(sets), np.concatenate(counts)
    m = docs.num_rows
    none = pa.nulls(len(sets), pa.int64())
    return pa.table({
        **{k: pa.concat_arrays([docs[k].combine_chunks(), none]) if m else none for k in ("id", "n")},
        "p": pa.concat_arrays([docs["p"].combine_chunks(), pa.array(sets)]) if m else pa.array(sets),
        **{k: pa.concat_arrays([docs[k].combine_chunks(), none]) if m else none for k in ("q", "h")},
        "shared": pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(counts, pa.int64())]),
    })


_SLICE = "part int, node binary, n bigint, grams binary"


def _slices(fragments: int, width: int):
    """Whole sets of the remaining documents, a row for each fragment."""
    def run(batches):
        for batch in batches:
            out = []
            for _, grams in shingle_sets(batch.column(0), width):
                p, q = _fingerprint(grams)
                node = np.array([p, q], ">i8").tobytes()
                part = (grams >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)
                cut = np.searchsorted(part, np.arange(fragments + 1, dtype=np.uint64))
                out += [(f, node, len(grams), grams[a:b].tobytes())
                        for f, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if a < b]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.binary(), pa.int64(), pa.binary()), strict=True)],
                    names=["part", "node", "n", "grams"])

    return run


def _frequencies(t: pa.Table) -> pa.Table:
    """One fragment: the shared shingles of each set, with the number of sets they occur in."""
    blobs = t["grams"].to_pylist()
    size = np.array([len(b) // 8 for b in blobs])
    grams = np.frombuffer(b"".join(blobs), np.uint64)
    _, where, count = np.unique(grams, return_inverse=True, return_counts=True)
    df = count[where]
    end = np.cumsum(size)
    keep = [(slice(a, b), df[a:b] > 1) for a, b in zip(end - size, end, strict=True)]
    return pa.table({
        "node": t["node"], "n": t["n"],
        "grams": pa.array([grams[s][k].astype(np.int64) for s, k in keep], pa.list_(pa.int64())),
        "df": pa.array([df[s][k] for s, k in keep], pa.list_(pa.int64())),
    })


_LED = "node binary, n bigint, shared bigint, slices array<array<bigint>>, lead array<bigint>"


def _order(slices: int):
    """Sets with all their shared shingles -> slices in hash order, and the leading ones by frequency."""
    def run(batches):
        for batch in batches:
            out = []
            for node, n, grams, df in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                g = np.array([x for part in grams for x in part], np.int64)
                f = np.array([x for part in df for x in part], np.int64)
                by = np.lexsort((g, f))
                own = n - len(g)  # its own shingles come first
                lead = g[by][:max(0, n - -(-4 * n // 5) + 1 - own)]
                part = ((g.view(np.uint64) >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(int)
                out.append((node, n, len(g), [g[part == k].tolist() for k in range(slices)], lead.tolist()))
            if out:
                types = (pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)],
                    names=["node", "n", "shared", "slices", "lead"])

    return run


def _possible(a: str, b: str):
    """Whether sizes, shared shingles and positions in the order still allow 4/5 in common."""
    c = F.col
    most = F.least(c(f"{a}.shared"), c(f"{b}.shared"),
                   c(f"{a}.n") - c(f"{a}.pos"), c(f"{b}.n") - c(f"{b}.pos"))
    return 5 * most >= 4 * (c(f"{a}.n") + c(f"{b}.n") - most)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) whose partial overlaps over all slices sum up to the similarity."""
    parts = sets.select("node", "n", F.posexplode("slices").alias("slice", "grams"))
    x = parts.select(F.col("node").alias("x"), F.col("n").alias("xn"), "slice", F.col("grams").alias("xg"))
    y = parts.select(F.col("node").alias("y"), F.col("n").alias("yn"), "slice", F.col("grams").alias("yg"))
    partial = pairs.join(x, "x").join(y, ["y", "slice"]).select(
        "x", "y", "xn", "yn", F.size(F.array_intersect("xg", "yg")).alias("common"))
    total = partial.groupBy("x", "y", "xn", "yn").agg(F.sum("common").alias("common"))
    return total.where(100 * F.col("common") >= percent * (F.col("xn") + F.col("yn") - F.col("common"))).select("x", "y")


def candidates_by_hub(posts: DataFrame) -> DataFrame:
    hub = posts.groupBy("gram").agg(
        F.count("*").alias("sets"),
        F.max(F.struct((F.col("shared") / F.col("n")).alias("r"), "n", "node", "shared", "pos")).alias("b")
    ).where("sets > 1").select("gram", "b")
    met = posts.select("gram", F.struct("node", "n", "shared", "pos").alias("a")).join(hub, "gram")
    return met.where((F.col("a.node") != F.col("b.node")) & _possible("a", "b")).select(
        F.least("a.node", "b.node").alias("x"), F.greatest("a.node", "b.node").alias("y")).distinct()


#: sizes of one band differ by up to this factor; a set is sent once for each of the two or three bands of its partners' sizes
_BAND = 1.25


def candidates_across(posts: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of sets of different components in one bucket.

    One side holds no set of the bucket's largest component, so sets that are connected
    already do not meet; bands of sizes keep sets apart that their bounds rule out.
    """
    posts = posts.join(roots, posts["node"] == roots["of"], "left").drop("of").withColumn(
        "root", F.coalesce("root", "node"))
    each = posts.groupBy("gram", "root").agg(F.count("*").alias("k"))
    open_ = each.groupBy("gram").agg(F.count("*").alias("roots"), F.max(F.struct("k", "root")).alias("top")).where(
        "roots > 1").select("gram", F.col("top.root").alias("top"))
    width = F.lit(np.log(_BAND))
    posts = posts.join(open_, "gram").withColumn("band", F.floor(F.log("n") / width).cast("int")).withColumn("top", F.col("root") == F.col("top"))
    top = F.least(F.col("n") * 1.25, 2.25 * F.col("shared") - F.col("n")) + 1
    low = F.greatest(F.col("n") * 0.8 - 1, F.lit(1))
    probe = posts.where(~F.col("top")).where(top >= low).select(
        "gram", F.struct("node", "n", "shared", "pos", "root").alias("a"),
        F.explode(F.sequence(F.floor(F.log(low) / width).cast("int"), F.floor(F.log(top) / width).cast("int"))).alias("band"))
    other = posts.select("gram", "band", F.struct("node", "n", "shared", "pos", "root", "top").alias("b"))
    # two sets that both probe meet once
    once = F.col("b.top") | (F.col("a.node") < F.col("b.node"))
    met = probe.join(other, ["gram", "band"]).where((F.col("a.root") != F.col("b.root")) & once & _possible("a", "b"))
    return met.select(F.least("a.node", "b.node").alias("x"), F.greatest("a.node", "b.node").alias("y")).distinct()


#: characters of text for each fragment, and shingles of remaining sets for each part, at most
_FRAGMENT_CHARS, _PART_SHINGLES = 20_000_000, 2_000_000


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80,
               width: int = 5, fragments: int | None = None, slices: int = 8) -> tuple[DataFrame, DataFrame]:
    """Documents grouped by links of at least ``percent`` Jaccard similarity of shingle sets.

    Returns two tables: per input row its id, ``n_shingles``, ``component_id`` (the
    smallest id reachable by links, its own included), ``h`` (hash of the text) and ``root``
    (128-bit name of the component, null without shingles), and the verified links that connect
    the components (``x``, ``y``: 128-bit names of different sets). These are enough to span each
    component, not all links in it: sets that are connected already form no further pairs.

    ``fragments``: cuts of the global order while sets are sifted, by default by the characters
    of all texts. Groups that a task takes whole hold a few million shingles, however large the
    input is. Only thresholds of 80 or more are supported, as the bounds assume it.

    Null, empty and blank texts have no shingles and are components of their own, and so is
    a row with a null id, whose component is that of its text's other rows, or null. Rows
    that repeat an id are kept as rows; each follows its own text. Other columns are ignored.
    An empty table gives empty tables.
    """
    if percent < 80:
        raise ValueError("the bounds of this join hold for 80 percent or more")
    spark = docs.sparkSession
    if fragments is None:
        chars = docs.agg(F.coalesce(F.sum(F.length(F.col(text_col).cast("string"))), F.lit(0))).first()[0]
        fragments = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), chars // _FRAGMENT_CHARS + 1)
    rows = docs.select(F.col(id_col).cast(_LONG).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    tally = stage(
        rows.mapInArrow(_map_side(fragments, width), _SENT_SQL).groupBy("part").applyInArrow(_fragment, _TALLY), "tally")

    facts = tally.where("shared IS NULL").select("id", "n", "p", "q", "h")
    classes = facts.where("n > 0").groupBy("p", "q").agg(
        F.max("n").alias("n"), F.min("id").alias("id"), F.min_by("h", F.struct("id", "h")).alias("h"))
    shared = tally.where("shared IS NOT NULL").groupBy("p").agg(F.sum("shared").alias("shared"))
    need = F.greatest(F.lit(1), F.ceil(F.ceil(4 * F.col("n") / 5) / 10))
    left = stage(classes.join(shared, "p").where(F.col("shared") >= need).select("id", "h", "n"), "left")
    shingles = left.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(4 * slices, shingles // _PART_SHINGLES + 1)

    # merged at every size: a broadcast that fits small inputs only would hide this shuffle
    texts = rows.join(left.hint("merge"), rows["id"].eqNullSafe(left["id"]) & (rows["h"] == left["h"]), "left_semi").select("text")
    cut = texts.mapInArrow(_slices(parts, width), _SLICE).dropDuplicates(["node", "part"])
    shared = cut.groupBy("part").applyInArrow(
        _frequencies, "node binary, n bigint, grams array<bigint>, df array<bigint>")
    sets = stage(shared.groupBy("node").agg(
        F.max("n").alias("n"), F.collect_list("grams").alias("grams"), F.collect_list("df").alias("df")
    ).mapInArrow(_order(slices), _LED).where("5 * shared >= 4 * n"), "sets")
    posts = sets.select("node", "n", "shared", F.posexplode("lead").alias("at", "gram")).withColumn(
        "pos", F.col("n") - F.col("shared") + F.col("at")).drop("at")

    first = stage(verified(candidates_by_hub(posts), sets, percent), "links")
    roots = components(first, "x", "y").select(F.col("node").alias("of"), "root")
    links = stage(first.union(verified(candidates_across(posts, roots), sets, percent)), "links")

    name = F.unhex(F.concat(*(F.lpad(F.hex(c), 16, "0") for c in ("p", "q"))))
    named = classes.select("p", "q", "id", name.alias("node"))
    grouped = named.join(components(links, "x", "y"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = grouped.groupBy("root").agg(F.min("id").alias("component_id"))
    grouped = grouped.join(least, "root").select("p", "q", "component_id", "root")
    out = facts.where("n > 0").join(grouped, ["p", "q"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "h", "root")
    none = facts.where("n = 0").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), "h", F.lit(None).cast("binary").alias("root"))
    return out.union(none), links


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input rows with one row of each component, that of the smallest (id, text hash), null
    ids last; rows without shingles all stay. See ``ngram_join``."""
    rows, _ = ngram_join(docs, id_col, text_col, **options)
    key = F.struct(F.col(id_col).isNull().alias("z"), F.col(id_col).alias("id"), "h")
    alone = rows.where("root IS NULL").groupBy(F.col(id_col).alias("id"), "h").agg(F.lit(1).alias("copies"))
    # rows of one id and one text are told apart by nothing; one of them stays
    best = rows.where("root IS NOT NULL").groupBy("root", key.alias("key")).agg(F.count("*").alias("copies")).groupBy("root").agg(
        F.min(F.struct("key", "copies")).alias("best")).select("best.key.id", "best.key.h", "best.copies")
    stay = best.union(alone).select(F.col("id").alias("__id"), F.col("h").alias("__h"), F.col("copies").alias("__n")).hint("merge")
    text = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    kept = docs.join(stay, docs[id_col].cast("bigint").eqNullSafe(F.col("__id")) & (text == F.col("__h")))
    once = kept.where("__n > 1").dropDuplicates(["__id", "__h"])
    return kept.where("__n = 1").union(once).select(*docs.columns)


@query("op1_ngram_jaccard_join")
def op1_ngram_jaccard_join(spark, sf_dir):
    return ngram_join(table(spark, sf_dir, "documents", "doc_id", "text"))[0].drop("h", "root")
