"""Profile of raw JSON lines and reports on input against output."""

from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import toxicity
from ..operators import perplexity as PP
from ..operators import profile as R
from ..operators import report as V
from ..sources.storage import stage
from . import oracle_sql as S
from .registry import documents, query, table
from .row_queries import SIDES_SQL, sides

# ------------------------------------------------------------------- corpus profile


def lines(spark, sf_dir):
    """One JSON document per row, of three shapes."""
    docs = table(spark, sf_dir, "documents").select(F.to_json(F.struct("*")).alias("value"))
    pages = table(spark, sf_dir, "pages").select(F.to_json(F.struct("*")).alias("value"))
    events = table(spark, sf_dir, "events", "props").select(F.col("props").alias("value"))
    return docs.unionByName(pages).unionByName(events)


_LINES = """(SELECT to_json(d)::varchar AS value FROM documents d UNION ALL
    SELECT to_json(p)::varchar FROM pages p UNION ALL SELECT props FROM events)"""
_FIELDS = f"""(SELECT key, value -> ('$."' || key || '"') AS item FROM (
    SELECT value, unnest(json_keys(value)) AS key FROM {_LINES}))"""
_TYPED = f"""(SELECT key, item ->> '$' AS s, CASE json_type(item)
    WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'bool' WHEN 'NULL' THEN 'null'
    WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' ELSE 'number' END AS type FROM {_FIELDS})"""


def _stats(spark, sf_dir):
    return stage(R.field_stats(lines(spark, sf_dir)), "fields")


def _total(spark, sf_dir):
    return R.line_total(lines(spark, sf_dir)).first()["lines"]


_FREQ = f"""SELECT key, count(*) AS docs,
    round(count(*) * 100.0::double / (SELECT count(*) FROM {_LINES}), 4) AS pct FROM {_FIELDS} GROUP BY key"""


@query("json_key_frequency", _FREQ)
def json_key_frequency(spark, sf_dir):
    return R.json_key_frequency(_stats(spark, sf_dir), _total(spark, sf_dir)).withColumn("pct", F.col("pct").cast("double"))


@query("json_key_types", f"SELECT key, type, count(*) AS docs FROM {_TYPED} GROUP BY key, type")
def json_key_types(spark, sf_dir):
    return R.json_key_types(_stats(spark, sf_dir))


_CANDIDATES = f"""SELECT key, count(*) AS docs, round(avg(length(s)), 4) AS mean_chars,
    min(length(s)) AS min_chars, max(length(s)) AS max_chars
    FROM {_TYPED} WHERE type = 'string' AND length(s) > 100 GROUP BY key"""


@query("text_field_candidates", _CANDIDATES)
def text_field_candidates(spark, sf_dir):
    return R.text_field_candidates(_stats(spark, sf_dir))


@query("recommend_text_field", f"SELECT key AS text_field FROM ({_CANDIDATES}) ORDER BY mean_chars DESC, key DESC LIMIT 1")
def recommend_text_field(spark, sf_dir):
    return R.recommend_text_field(_stats(spark, sf_dir))


@query("doc_size_stats", f"""
    SELECT round(avg(length(value)), 4) AS mean_chars, min(length(value)) AS min_chars, max(length(value)) AS max_chars,
           round(avg(strlen(value)), 4) AS mean_bytes, min(strlen(value)) AS min_bytes, max(strlen(value)) AS max_bytes,
           median(length(value))::double AS median_chars, median(strlen(value))::double AS median_bytes FROM {_LINES}""")
def doc_size_stats(spark, sf_dir):
    return R.doc_size_stats(lines(spark, sf_dir))


@query("batch_advice", f"""
    SELECT CASE WHEN avg(length(value)) < 10000 THEN 'small' WHEN avg(length(value)) < 100000 THEN 'medium'
           ELSE 'large' END AS size_class FROM {_LINES}""")
def batch_advice(spark, sf_dir):
    return lines(spark, sf_dir).agg(R.size_class(F.avg(F.length("value"))).alias("size_class"))


@query("metadata_coverage", f"SELECT * FROM ({_FREQ}) WHERE key IN ({', '.join(map(S.lit, P.METADATA_KEYS))})")
def metadata_coverage(spark, sf_dir):
    return R.metadata_coverage(_stats(spark, sf_dir), _total(spark, sf_dir)).withColumn("pct", F.col("pct").cast("double"))


_MAYBE_BLANK = "CASE WHEN lang = 'fr' THEN '  ' || chr(10) WHEN lang = 'de' THEN NULL ELSE text END"


@query("empty_text_count", "SELECT count(*) AS empty_docs FROM documents WHERE lang IN ('fr', 'de') OR trim(text) = ''")
def empty_text_count(spark, sf_dir):
    """French texts blanked, German ones null: both count as empty."""
    blanked = documents(spark, sf_dir, "text", "lang").select(F.to_json(
        F.struct(F.expr(_MAYBE_BLANK.replace("chr(10)", "char(10)")).alias("text")),
        {"ignoreNullFields": "false"}).alias("value"))
    return R.empty_text_count(R.field_stats(blanked), "text")


@query("malformed_count", """
    SELECT (SELECT count(*) FROM conversations) + (SELECT count(*) FROM events) AS lines,
           (SELECT count(*) FROM conversations WHERE NOT json_valid(text)) AS malformed""")
def malformed_count(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations", "text").toDF("value")
    return R.malformed_count(talk.unionByName(table(spark, sf_dir, "events", "props").toDF("value")))


@query("sample_docs", "SELECT doc_id, lang, substring(text, 1, 500) AS text FROM documents ORDER BY doc_id LIMIT 3")
def sample_docs(spark, sf_dir):
    return R.sample_docs(documents(spark, sf_dir, "doc_id", "lang", "text"), ["doc_id"], ["doc_id", "lang", "text"])


@query("profile_corpus", f"""
    SELECT (SELECT key FROM ({_CANDIDATES}) ORDER BY mean_chars DESC, key DESC LIMIT 1) AS text_field,
           (SELECT count(*) FROM ({_FREQ})) AS fields,
           (SELECT string_agg(key, ',' ORDER BY key) FROM ({_FREQ})
            WHERE key IN ({', '.join(map(S.lit, P.METADATA_KEYS))})) AS metadata_fields,
           (SELECT count(*) FROM {_LINES}) AS lines, 0::bigint AS malformed,
           (SELECT round(avg(length(value)), 4) FROM {_LINES}) AS mean_chars""")
def profile_corpus(spark, sf_dir):
    return R.profile_corpus(lines(spark, sf_dir)).select(
        "text_field", "fields", F.array_join("metadata_fields", ",").alias("metadata_fields"),
        "lines", "malformed", "mean_chars")


# -------------------------------------------------------------------- length reports


@query("length_stats", f"""
    SELECT side, count(*) AS docs, round(avg(length(text)), 4) AS mean_chars, min(length(text)) AS min_chars,
           max(length(text)) AS max_chars, round(avg(w), 4) AS mean_words, min(w) AS min_words, max(w) AS max_words
    FROM (SELECT *, {S.words('text')} AS w FROM {SIDES_SQL}) GROUP BY side""")
def length_stats(spark, sf_dir):
    return V.length_stats(sides(spark, sf_dir))


def _bins_sql(value: str, unit: str, power: int) -> str:
    edges = V.log_edges(power)
    at = " + ".join(f"({value} >= {e!r})::int" for e in edges)
    return (f"SELECT side, '{unit}' AS unit, CASE WHEN {value} > {edges[-1]!r} THEN {len(edges) - 1} "
            f"ELSE least({at} - 1, {len(edges) - 2}) END::bigint AS bin FROM {SIDES_SQL}")


@query("length_histogram_log", f"""
    SELECT side, unit, bin, count(*) AS docs FROM (
    {_bins_sql('length(text)', 'chars', 5)} UNION ALL {_bins_sql(S.words('text'), 'words', 4)})
    GROUP BY side, unit, bin""")
def length_histogram_log(spark, sf_dir):
    return V.length_histogram_log(sides(spark, sf_dir))


# ------------------------------------------------------------------ integrity reports

_PAGE_SIDES = f"""(SELECT 'input' AS side, page_id AS doc_id, html AS text FROM pages UNION ALL
    SELECT 'output', page_id, {S.html_text('html')} FROM pages)"""


def _page_sides(spark, sf_dir):
    from ..functions.text import html_to_text_native
    from ..sources.jsonl import pair

    pages = table(spark, sf_dir, "pages", "page_id", "html").toDF("doc_id", "text")
    return pair(pages, pages.withColumn("text", html_to_text_native(F.col("text"))))


def _flag(name: str, pattern: str) -> str:
    n = f"count(*) FILTER (WHERE regexp_matches(text, {S.lit(pattern)}))"
    return f"{n} AS {name}_docs, round({n} * 100.0::double / count(*), 4) AS {name}_pct"


@query("integrity_scan", f"""
    SELECT side, count(*) AS docs, {_flag('html', P.HTML_TAG)}, {_flag('code', P.CODE_KEYWORD)},
           {_flag('whitespace', P.WIDE_SPACE)} FROM {_PAGE_SIDES} GROUP BY side""")
def integrity_scan(spark, sf_dir):
    """Raw pages against their extracted text."""
    return V.integrity_scan(_page_sides(spark, sf_dir))


@query("uniqueness_check", f"""
    SELECT side, count(*) AS docs, count(DISTINCT doc_id) AS unique_ids, count(DISTINCT text) AS unique_texts,
           count(*) - count(DISTINCT text) AS duplicate_texts,
           round((count(*) - count(DISTINCT text)) * 100.0::double / count(*), 4) AS duplicate_pct
    FROM {SIDES_SQL} GROUP BY side""")
def uniqueness_check(spark, sf_dir):
    return V.uniqueness_check(sides(spark, sf_dir))


# --------------------------------------------------------------------- safety reports

_LEAKS = " UNION ALL ".join(
    f"SELECT side, '{kind}' AS kind, {S.hits('text', p)} AS n FROM {SIDES_SQL}"
    for kind, p in (("email", P.EMAIL), ("ip", P.IPV4), ("phone", P.PHONE)))


@query("pii_leak_report", f"""
    SELECT side, kind, sum(n)::bigint AS occurrences, count(*) FILTER (WHERE n > 0) AS docs_affected, count(*) AS docs,
           round(sum(n) * 100.0::double / count(*), 4) AS occurrence_pct,
           round(count(*) FILTER (WHERE n > 0) * 100.0::double / count(*), 4) AS docs_pct
    FROM ({_LEAKS}) GROUP BY side, kind""")
def pii_leak_report(spark, sf_dir):
    return V.pii_leak_report(sides(spark, sf_dir))


@query("redaction_tag_count", f"SELECT side, sum({S.hits('text', P.REDACTION_TAG)})::bigint AS tags FROM {SIDES_SQL} GROUP BY side")
def redaction_tag_count(spark, sf_dir):
    return V.redaction_tag_count(sides(spark, sf_dir))


@query("redaction_examples", f"""
    SELECT side, tag, min(doc_id) AS first_doc, arg_min(substring(text, 1, 300), doc_id) AS example
    FROM {SIDES_SQL}, (VALUES ('<EMAIL>'), ('<IP>'), ('<PHONE>')) t(tag)
    WHERE contains(text, tag) GROUP BY side, tag""")
def redaction_examples(spark, sf_dir):
    return V.redaction_examples(sides(spark, sf_dir), "doc_id")


SAMPLE = 100  # the sampling operator's own limit


@query("sample_docs_random", f"SELECT doc_id, text FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT {SAMPLE}")
def sample_docs_random(spark, sf_dir):
    return V.sample_docs_random(documents(spark, sf_dir), SAMPLE)


# a lexicon per category, cut from one word list
LEXICONS = {"toxicity": S.LEXICON, "insult": ("idiot", "moron", "clown", "stupid", "loser"), "obscene": ("scum", "trash")}
toxicity.SCORERS.register("sample_lexicon", toxicity.lexicon_scorer(LEXICONS))


def _above(category: str) -> str:
    words = LEXICONS.get(category)
    if not words:
        return "false"
    return f"least(1.0, {S.whole_words('text', words)}::double / {S.words('text')} * 500) > 0.5"


@query("toxicity_scores", f"""
    SELECT 'input' AS side, category, count(*) AS docs, count(*) FILTER (WHERE hit) AS toxic_docs,
           round(count(*) FILTER (WHERE hit) * 100.0::double / count(*), 4) AS toxic_pct
    FROM ({' UNION ALL '.join(f"SELECT '{c}' AS category, {_above(c)} AS hit FROM documents" for c in P.TOXICITY_CATEGORIES)})
    GROUP BY category""")
def toxicity_scores(spark, sf_dir):
    return V.toxicity_scores(documents(spark, sf_dir).withColumn("side", F.lit("input")), "sample_lexicon")


# ------------------------------------------------------------------- language reports

_LABELLED = f"(SELECT side, replace(label, '__label__', '') AS lang_label FROM ({S.language(SIDES_SQL)}))"


@query("language_distribution", f"SELECT side, lang_label, count(*) AS docs FROM {_LABELLED} GROUP BY side, lang_label")
def language_distribution(spark, sf_dir):
    return V.language_distribution(sides(spark, sf_dir))


@query("english_vs_other", f"""
    SELECT side, count(*) FILTER (WHERE lang_label = 'en') AS english, count(*) FILTER (WHERE lang_label <> 'en') AS other,
           count(*) AS total, round(count(*) FILTER (WHERE lang_label = 'en') * 100.0::double / count(*), 4) AS english_pct,
           round(count(*) FILTER (WHERE lang_label <> 'en') * 100.0::double / count(*), 4) AS other_pct
    FROM {_LABELLED} GROUP BY side""")
def english_vs_other(spark, sf_dir):
    return V.english_vs_other(sides(spark, sf_dir))


# ------------------------------------------------------------------------- perplexity

WINDOWS = PP.Windows(context=256, stride=128)
_TOKENS = r"(SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM documents)"


@query("perplexity_windows", f"""
    SELECT doc_id, win::bigint AS "window", win * 128 AS "begin", least(win * 128 + 256, n) AS "end",
           least(win * 128 + 256, n) - CASE WHEN win = 0 THEN 0 ELSE (win - 1) * 128 + 256 END AS target_len
    FROM (SELECT doc_id, len(w)::bigint AS n, unnest(range(0, len(w)::bigint, 128)) // 128 AS win FROM {_TOKENS})
    WHERE win = 0 OR (win - 1) * 128 + 256 < n""")
def perplexity_windows(spark, sf_dir):
    return PP.perplexity_windows(documents(spark, sf_dir), WINDOWS)


_PERPLEXITY = f"""
    WITH pairs AS MATERIALIZED (
      SELECT doc_id, CASE WHEN i < 256 THEN 0 ELSE 1 + (i - 256) // 128 END AS win, w[i] AS a, w[i + 1] AS b
      FROM (SELECT doc_id, w, unnest(range(1, len(w)::bigint)) AS i FROM {_TOKENS})),
    grams AS MATERIALIZED (SELECT a, b, count(*) AS n FROM pairs GROUP BY a, b),
    firsts AS MATERIALIZED (SELECT a, sum(n) AS total FROM grams GROUP BY a),
    vocab AS (SELECT count(DISTINCT x) AS v FROM (SELECT unnest(w) AS x FROM {_TOKENS})),
    model AS MATERIALIZED (
      SELECT a, b, -ln((n + 0.1::double) / (total + 0.1::double * (SELECT v FROM vocab))) AS loss
      FROM grams JOIN firsts USING (a)),
    windows AS (SELECT doc_id, win, avg(loss) AS loss FROM pairs JOIN model USING (a, b) GROUP BY doc_id, win),
    scores AS (SELECT doc_id, count(*) AS windows, exp(avg(loss)) AS perplexity FROM windows GROUP BY doc_id)"""


@query("perplexity", f"""{_PERPLEXITY}
    SELECT d.doc_id, coalesce(windows, 0) AS windows, round(coalesce(perplexity, -1), 4) AS perplexity
    FROM documents d LEFT JOIN scores USING (doc_id)""")
def perplexity(spark, sf_dir):
    """NaN is shown as -1."""
    return PP.perplexity(documents(spark, sf_dir), WINDOWS).withColumn(
        "perplexity", F.round(F.when(F.isnan("perplexity"), -1.0).otherwise(F.col("perplexity")), 4))


def _scores(spark, sf_dir):
    return PP.perplexity(documents(spark, sf_dir), WINDOWS).withColumn("side", F.lit("input"))


@query("perplexity_stats", f"""{_PERPLEXITY}
    SELECT 'input' AS side, count(*) AS docs, count(*) - count(perplexity) AS unscored,
           round(avg(perplexity), 4) AS mean, round(median(perplexity), 4) AS median
    FROM documents LEFT JOIN scores USING (doc_id)""")
def perplexity_stats(spark, sf_dir):
    """All documents; those of one word or none have no score."""
    return PP.perplexity_stats(_scores(spark, sf_dir)).withColumns(
        {c: F.round(c, 4) for c in ("mean", "median")})


TOP = 5000.0


@query("perplexity_histogram", f"""{_PERPLEXITY}
    SELECT 'input' AS side, CASE WHEN perplexity IS NULL THEN -1 WHEN perplexity > {TOP} THEN 49
           ELSE least(floor(perplexity / ({TOP} / 49)), 48) END::bigint AS bin, count(*) AS docs
    FROM documents LEFT JOIN scores USING (doc_id) GROUP BY bin""")
def perplexity_histogram(spark, sf_dir):
    """49 bins, one above and one for unscored documents; the range is wider than for a neural
    model, whose perplexities are lower."""
    return PP.perplexity_histogram(_scores(spark, sf_dir), top=TOP)
