"""URL filter: pattern rules found by their rarest literal token.

Every rule is a regular expression over ``host + path`` with the literal tokens that any
match must contain. A rule is filed under that token of its own which fewest URLs hold; the
distinct tokens of a URL fetch its candidate rules by an equi-join, and only those run.
"""

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import query, table

TOKEN = "[a-z0-9]+"
#: longest list of rules that is broadcast; a longer one joins by a shuffle
_BROADCAST_RULES = 5_000


@dataclass(frozen=True)
class Rule:
    """A pattern with its verdict. ``base`` rules win over others, longer names over shorter."""

    name: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    base: bool = False


def site_rule(name: str, verdict: str) -> Rule:
    """``host/path``: fits the host, its subdomains and every path that starts with the rule's."""
    host, path = name.split("/", 1)
    if not host or re.search(r"[^a-z0-9.-]", host):
        raise ValueError(f"not a host: {name}")
    # a path may go on inside its last token, so only tokens followed by more are sure
    whole = re.findall(TOKEN, host) + re.findall(rf"{TOKEN}(?=[^a-z0-9])", path.lower())
    return Rule(name, rf"^([^/]*\.)?{_literal(host)}/{_literal(path)}", tuple(whole), verdict, True)


def label_rule(*words: str) -> Rule:
    """Blocks hosts that have these words next to each other in one label (``free-bets.``)."""
    name = "-".join(words)
    return Rule(name, rf"^([^/]*[^a-z0-9/])?{name}([^a-z0-9/][^/]*)?(/|$)", tuple(words), "block")


def _literal(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


#: the rules of the contract, then those of the method for what they leave open
BASE_RULES = (
    site_rule("net/", "block"), site_rule("example.net/en/", "allow"),
    site_rule("example.com/de/", "block"), site_rule("org/fr/", "allow"))
OWN_RULES = tuple(label_rule(*w.split()) for w in (
    "spam farm", "free bets", "adult x", "online casino", "free casino", "porn", "xxx", "casino", "viagra"))


def _parts(url):
    """host and path of a URL column; both empty without ``://``."""
    tail = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(tail, r"^[^/?#]*", 0)
    path = F.regexp_extract(tail, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + OWN_RULES,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per input row: id, ``host``, ``path``, ``rule`` and ``verdict`` (allow or block), and ``pattern``.

    ``rule`` is the longest base rule that fits, or null; then ``pattern`` names the longest
    other rule that fits, and ``verdict`` is that of either, or allow. A null URL or one without
    ``://`` has empty parts and is allowed. Rows are judged one by one, so null and repeated
    ids stay; extra columns are ignored; an empty table gives an empty one.

    The tokens of a row come together again in one step that is combined before its shuffle;
    it is dealt by row, so a host with a third of all rows is no hot key.
    """
    spark = pages.sparkSession
    host, path = _parts(F.col("url"))
    rows = pages.select(F.col(id_col).alias("key"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url")).select(
        "key", host.alias("host"), path.alias("path"))
    asked = F.array_distinct(F.regexp_extract_all(F.lower(F.concat("host", F.lit("/"), "path")), F.lit(TOKEN), F.lit(0)))
    filed = spark.createDataFrame(
        [(r.name, r.pattern, r.verdict, r.base, list(r.tokens)) for r in rules],
        "name string, regex string, verdict string, base boolean, tokens array<string>")
    broad = F.broadcast if len(rules) <= _BROADCAST_RULES else (lambda df: df)
    # how many URLs hold each token of the rules
    used = filed.select(F.explode("tokens").alias("token")).distinct()
    counts = rows.select(F.explode(asked).alias("token")).join(broad(used), "token").groupBy("token").agg(F.count("*").alias("urls"))
    rarest = filed.select("name", F.explode("tokens").alias("token")).join(broad(counts), "token", "left").groupBy("name").agg(
        F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token")).alias("least"))
    index = filed.join(rarest, "name").select(
        F.col("least.token").alias("token"), F.struct(F.length("name").alias("size"), "name", "verdict", "base", "regex").alias("rule"))
    # all rules of a token in one row, so that a URL token meets at most one
    index = index.groupBy("token").agg(F.collect_list("rule").alias("rules"))

    listed = rows.withColumn("id", F.monotonically_increasing_id()).withColumn("token", F.explode_outer(asked))
    fits = F.filter("rules", lambda r: F.regexp_like(F.concat("host", "path"), r["regex"]))
    found = listed.join(broad(index), "token", "left").select("id", "key", "host", "path", fits.alias("fit"))
    best = lambda base: F.array_max(F.transform(
        F.filter("fit", lambda r: r["base"] == F.lit(base)), lambda r: F.struct(r["size"], r["name"], r["verdict"])))
    judged = found.select("id", "key", "host", "path", best(True).alias("own"), best(False).alias("other"))
    one = judged.groupBy("id").agg(
        F.first("key").alias("key"), F.first("host").alias("host"), F.first("path").alias("path"),
        F.max("own").alias("own"), F.max("other").alias("other"))
    return one.select(
        F.col("key").alias(id_col), "host", "path", F.col("own.name").alias("rule"),
        F.coalesce("own.verdict", "other.verdict", F.lit("allow")).alias("verdict"),
        F.when(F.col("own").isNull(), F.col("other.name")).alias("pattern"))



_SQL = r"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
h AS (SELECT page_id, translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM p),
r AS (SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM h)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches(host, '(^|[^a-z0-9])(spam-farm|free-bets|adult-x|online-casino|free-casino|porn|xxx|casino|viagra)([^a-z0-9]|$)')
    THEN 'block' ELSE 'allow' END AS verdict
FROM r"""


@query("op4_url_rules", _SQL)
def op4_url_rules(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages", "page_id", "url")).drop("pattern")
