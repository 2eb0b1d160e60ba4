"""Benchmark decontamination by templates.

Numbers, units and names of a text are typed slots; what is left is its template. Windows of
template words are joined by hash with those of the benchmark items. Windows that agree on
one alignment are a match if enough of the item is there and its slots are filled consistently:
one value of the item always stands for the same value of the document, and vice versa.
So a question with other numbers or names is found, and a mere similarity of form is not. Names are
known by their capitals, so the windows of an item are filed a second time with names as words:
a copy in lower case or in capitals is found by these.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ingest import computed_once
from .registry import query, table
from .windows import add_windows, words_of

#: private characters that mark a slot; fixed values
NUMBER, UNIT, NAME, _AFTER = "", "", "", ""
UNITS = ("km|m|cm|mm|mi|ft|kg|g|mg|lb|oz|l|ml|s|ms|min|h|hz|khz|mhz|ghz|kb|mb|gb|tb|w|kw|kwh|v|percent|degrees|"
         "meters|metres|miles|feet|inches|grams|kilograms|pounds|liters|litres|seconds|minutes|hours|days|weeks|months|years|"
         "dollars|euros|cents|usd|eur")
_NUMBER = rf"(?<![A-Za-z0-9])([0-9]+(?:[.,:][0-9]+)*)(?:\s?((?i:{UNITS}))(?![A-Za-z0-9]))?(?![A-Za-z0-9])"
#: a capital after a lower-case word; after a comma only if the next letter is lower case, as in a
#: text in capitals all words are such
_NAME = r"\p{Lu}(?:(?<=\p{Ll} .)|(?<=[,;] .)(?=\p{Ll}))\p{L}*"
#: ASCII other than letters and digits ends a word, but for marks inside a number
_BETWEEN = r"(?:[\x00-\x2B\x2D\x2F\x3B-\x40\x5B-\x60\x7B-\x7F]|[.,:](?![0-9])|(?<![0-9])[.,:])+"
#: words of a window, literal words it must have, windows of one alignment that make a match
WINDOW, LITERAL, ENOUGH = 8, 4, 6
#: windows of the benchmark up to which they are broadcast; more go through a shuffle
BROADCAST_WINDOWS = 200_000


def tokens_of(text: Column) -> Column:
    """Words, lower-cased; a slot is its mark and its value."""
    named = F.regexp_replace(text, _NAME, f"{NAME}$0")
    marked = F.regexp_replace(named, _NUMBER, f" {NUMBER}$1 {UNIT}$2 ")
    return F.array_remove(words_of(F.lower(marked), _BETWEEN), UNIT)


def _is_slot(token: Column) -> Column:
    return (token >= NUMBER) & (token < _AFTER)


def _template(tokens: Column) -> Column:
    """Hashes of the words; a slot counts by its type. The lowest bit says whether it is literal."""
    return F.transform(tokens, lambda t: F.when(_is_slot(t), F.xxhash64(F.substring(t, 1, 1)).bitwiseAND(F.lit(-2))).otherwise(
        F.xxhash64(t).bitwiseOR(F.lit(1))))


def _enough_literal(template: Column, size: int) -> Column:
    """Whether each whole window has enough literal words."""
    literal = F.transform(template, lambda t: t.bitwiseAND(F.lit(1)))
    return F.transform(F.sequence(F.lit(1), F.size(template) - size + 1), lambda i: F.aggregate(
        F.slice(literal, i, size), F.lit(0).cast("bigint"), lambda s, x: s + x) >= min(LITERAL, size))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", leaks_col: str = "leaks") -> DataFrame:
    """The input rows with a column ``leaks_col``: for each benchmark item found in the text an entry
    (``item_id``, ``start`` and ``words`` of the place in words of the text, ``share`` of the
    item's windows, ``exact``: all slots from the first to the last window found hold the item's own values);
    null if there is none. Only those slots have to be consistent.

    A match needs ENOUGH windows of one alignment, or as many as the item has with names as slots. Items of fewer
    than WINDOW words are one window; items with fewer than LITERAL literal words have no
    template of their own and are never found. All windows of all texts take part.

    Null and empty texts and items have no windows. Rows of one id with different texts are
    judged by all windows of that id but checked each by its own text; rows with a null id are
    told apart by their text. Repeated items, and items that share windows, are each reported.
    Extra columns stay; one named ``leaks_col`` is refused. Empty tables give no leaks.
    """
    if leaks_col in docs.columns:
        raise ValueError(f"the input has a column {leaks_col!r}; name another as leaks_col")
    # as a struct a null id equals a null id
    said = F.coalesce(F.col(item_text).cast("string"), F.lit(""))
    items = benchmark.select(F.struct(F.col(item_col).alias("id")).alias("item"), tokens_of(said).alias("item_tokens"), tokens_of(F.lower(said)).alias("plain"))
    items = items.where(F.size("item_tokens") >= LITERAL).distinct()
    sizes = sorted(r.n for r in items.select(F.least(F.size("item_tokens"), F.lit(WINDOW)).alias("n")).distinct().collect())
    rows = docs.withColumn("__h", F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    if not sizes:
        leak = f"array<struct<item_id:{dict(benchmark.dtypes)[item_col]},start:int,words:int,share:double,exact:boolean>>"
        return rows.drop("__h").withColumn(leaks_col, F.lit(None).cast(leak))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    slots = F.filter(F.transform("item_tokens", lambda t, i: F.struct(i.alias("at"), t.alias("value"))), lambda s: _is_slot(s["value"]))
    items = computed_once(items, slots=slots, template=_template(F.col("item_tokens")), plain=_template(F.col("plain")))
    listed = None
    for size in sizes:
        for named, template in ((True, "template"), (False, "plain")):
            part = add_windows(items.where(F.least(F.size("item_tokens"), F.lit(WINDOW)) == size), template, size, "windows")
            # a text's window equals an item's only if it has as many literal words, so only items are asked
            part = part.select("item", "slots", F.size("item_tokens").alias("length"), F.lit(size).alias("size"), F.lit(named).alias("named"), F.filter(F.transform(
                F.arrays_zip(F.slice("windows", 1, F.size(template) - size + 1).alias("window"), _enough_literal(F.col(template), size).alias("use")),
                lambda w, i: F.struct(i.alias("item_at"), w["window"].alias("window"), w["use"].alias("use"))), lambda w: w["use"]).alias("windows"))
            listed = part if listed is None else listed.union(part)
    keys = listed.select("size", "item", F.inline("windows")).drop("use").distinct()
    small = keys.select(F.count("*")).first()[0] <= BROADCAST_WINDOWS

    template = computed_once(rows.select(F.col(id_col).alias("__id"), "__h", text.alias("text")), tokens=tokens_of(F.col("text")))
    template = computed_once(template.drop("text"), template=_template(F.col("tokens"))).drop("tokens")
    met = []
    for size in sizes:
        own = keys.where(F.col("size") == size).drop("size")
        met.append(add_windows(template, "template", size, "windows").select(
            "__id", "__h", F.posexplode("windows").alias("at", "window")).join(F.broadcast(own) if small else own.hint("merge"), "window"))
    hits = met[0]
    for more in met[1:]:
        hits = hits.union(more)
    aligned = hits.groupBy("__id", "__h", "item", (F.col("at") - F.col("item_at")).alias("start")).agg(
        F.countDistinct("item_at").alias("windows"), F.min("item_at").alias("first"), F.max("item_at").alias("last"))
    count = F.size("windows")
    facts = listed.groupBy("item", "length", "slots").agg(F.max(F.when(F.col("named"), count)).alias("own"), F.max(count).alias("all"))
    facts = facts.select("item", "length", "slots", F.when(F.col("own") > 0, F.col("own")).otherwise(F.col("all")).alias("usable"))
    enough = aligned.join(F.broadcast(facts) if small else facts, "item").where(
        F.col("windows") >= F.least(F.lit(ENOUGH), F.col("usable")))
    # of a part of an item, the text before and after it says nothing about the item's slots
    held = F.filter("slots", lambda s: (s["at"] >= F.col("first")) & (s["at"] < F.col("last") + F.least("length", F.lit(WINDOW))))
    per_row = enough.groupBy("__id", "__h").agg(F.collect_list(F.struct(
        "item", "start", "length", F.least(F.col("windows") / F.col("usable"), F.lit(1.0)).alias("share"), held.alias("slots"))).alias("__met"))

    # one shuffle of the texts, merged at every size
    joined = rows.join(per_row.select(F.col("__id"), F.col("__h").alias("__g"), "__met").hint("merge"),
                       F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__g")), "left")
    tokens = tokens_of(text)
    filled = F.transform("__met", lambda m: F.struct(m["item"].alias("item"), m["start"].alias("start"), m["length"].alias("length"),
                                                     m["share"].alias("share"), _filled(m, F.col("__tokens")).alias("pairs")))
    joined = computed_once(joined, __tokens=F.when(F.col("__met").isNotNull(), tokens))
    joined = computed_once(joined, __filled=filled)
    leaks = F.transform(F.filter("__filled", lambda m: _consistent(m["pairs"])), lambda m: F.struct(
        m["item"]["id"].alias("item_id"), m["start"].alias("start"), m["length"].alias("words"), m["share"].alias("share"),
        F.forall(m["pairs"], lambda p: p["a"] == p["b"]).alias("exact")))
    leaks = F.array_sort(leaks)
    return joined.withColumn(leaks_col, F.when(F.size(leaks) > 0, leaks)).drop("__h", "__g", "__id", "__met", "__tokens", "__filled")


def _filled(m, tokens: Column) -> Column:
    """(value of the item, value of the text) of each slot whose place holds a slot of that type."""
    both = F.transform(m["slots"], lambda s: F.struct(s["value"].alias("a"), F.get(tokens, m["start"] + s["at"]).alias("b")))
    return F.array_distinct(F.filter(both, lambda p: F.substring(p["a"], 1, 1) == F.substring(p["b"], 1, 1)))


def _consistent(pairs) -> Column:
    """Whether distinct pairs are one to one."""
    side = lambda k: F.size(F.array_distinct(F.transform(pairs, lambda p: p[k])))
    return (side("a") == F.size(pairs)) & (side("b") == F.size(pairs))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """The rows in whose text no benchmark item is found; see ``find_leaks``."""
    return find_leaks(docs, benchmark, leaks_col="__leaks", **columns).where("__leaks IS NULL").drop("__leaks")


@query("op5_template_decontamination")
def op5_template_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.where("leaks IS NOT NULL").select("doc_id", F.inline("leaks"))
