"""Row-level queries: cleaning, ingestion, language, personal data, toxicity, quality."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import language, markup, pii, toxicity
from ..functions import patterns as P
from ..functions import text as X
from ..functions.scoring import LetterModel, batch_scorer
from ..operators import dedup as D
from ..operators import ingest as I
from ..operators import quality as Q
from ..operators.tokenize import tokenize
from ..sources.jsonl import pair
from . import oracle_sql as S
from .registry import documents, query, table, text_query


# ------------------------------------------------------------------ cleaning (pages)

text_query("html_to_text_sql", X.html_to_text_native, S.html_text("html"), source="pages")
text_query("html_to_text", markup.html_to_text, S.unescape(S.html_text("html"), more=True), source="pages")
text_query("strip_tags_regex", X.strip_tags, S.rx("html", "<[^>]+>"), source="pages")
text_query("html_unescape_sql", X.unescape_basic, S.unescape("html"), source="pages")
text_query("html_unescape", markup.html_unescape, S.unescape("html", more=True), source="pages")


@query("clean_text", f"SELECT page_id, {S.tidy(S.unescape(S.unescape(S.html_text('html'), True), True))} AS result FROM pages")
def clean_text(spark, sf_dir):
    """The whole chain on raw pages."""
    return I.clean_text(table(spark, sf_dir, "pages", "page_id", "html"), "html").withColumnRenamed("html", "result")


# The corpus holds clean prose, so the steps below get texts with dirt put in at fixed
# places, by the same replacements in Spark and SQL.


def decomposed(text):
    return F.replace(text, F.lit("é"), F.lit("é"))


def with_controls(text):
    return F.replace(text, F.lit(" o"), F.lit("​\u0007\r o­"))


def with_blanks(text):
    text = F.replace(text, F.lit(" a"), F.lit(" \ta"))
    text = F.replace(text, F.lit(". "), F.lit(".  \n\n\n \n\t  "))
    return F.concat(F.lit(" \n\t"), F.replace(text, F.lit(" t"), F.lit(" \t  t")), F.lit(" \n "))


_CONTROLS = "replace(text, ' o', chr(8203) || chr(7) || chr(13) || ' o' || chr(173))"
_BLANKS = (
    "(' ' || chr(10) || chr(9) || replace(replace(replace(text, ' a', chr(160) || chr(9) || 'a'), "
    "'. ', '.  ' || repeat(chr(10), 3) || ' ' || chr(10) || chr(9) || '  '), "
    "' t', ' ' || chr(9) || '  t') || ' ' || chr(10) || ' ')")

text_query("normalize_nfc", lambda t: markup.normalize_nfc(decomposed(t)),
           "nfc_normalize(replace(text, chr(233), 'e' || chr(769)))")
text_query("strip_control", lambda t: X.strip_control(with_controls(t)), S.strip_control(_CONTROLS))
text_query("spaces_standardize", lambda t: X.standardize_spaces(with_blanks(t)), S.spaces(_BLANKS))
text_query("strip_lines", lambda t: X.strip_lines(X.standardize_spaces(with_blanks(t))), S.strip_lines(S.spaces(_BLANKS)))
text_query("collapse_newlines", lambda t: X.collapse_newlines(with_blanks(t)), S.newlines(_BLANKS))
text_query("collapse_spaces", lambda t: X.collapse_spaces(with_blanks(t)), S.collapse(_BLANKS))
text_query("trim_text", lambda t: X.trim_unicode(with_blanks(t)), S.trim(_BLANKS))
text_query("clean_text_native", lambda t: X.tidy(with_blanks(t)), S.tidy(_BLANKS))

# -------------------------------------------------------------- ingestion: measures

text_query("char_count", X.char_count, "length(text)::bigint")
text_query("word_count", X.word_count, f"{S.words('text')}::bigint")
text_query("code_keyword_count", X.code_keyword_count, f"{S.hits('html', P.CODE_KEYWORD)}::bigint", source="pages")
text_query("code_symbol_density", lambda t: F.round(X.code_symbol_density(t), 9),
           f"round({S.code_symbols('html')}, 9)", source="pages")
text_query("doc_id_md5", lambda t: X.doc_id(t, "md5"), "md5(text)")


@query("doc_id_xxh64", """
    SELECT first_doc, docs, '16 ' || kind AS form FROM (SELECT min(doc_id) AS first_doc, count(*) AS docs FROM documents GROUP BY text),
           (VALUES ('native'), ('seed0')) k(kind)""")
def doc_id_xxh64(spark, sf_dir):
    """64-bit ids, native with seed 42 and with seed 0 through the Arrow UDF: as many digits
    and the same groups of documents as by text."""
    ids = documents(spark, sf_dir).select("doc_id", F.explode(F.create_map(
        F.lit("native"), X.doc_id(F.col("text")), F.lit("seed0"), X.doc_id(F.col("text"), "xxh64"))).alias("kind", "id"))
    return ids.groupBy("kind", "id").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("docs")).select(
        "first_doc", "docs", F.concat_ws(" ", F.length("id"), "kind").alias("form"))


@query("filter_min_length", "SELECT doc_id, text FROM documents WHERE length(text) >= 100")
def filter_min_length(spark, sf_dir):
    return documents(spark, sf_dir).where(I.long_enough(F.col("text"), 100))


@query("filter_code", f"SELECT page_id FROM pages WHERE NOT {S.is_code('html')}")
def filter_code(spark, sf_dir):
    return table(spark, sf_dir, "pages", "page_id", "html").where(~X.is_code(F.col("html"))).select("page_id")


RAW_ONLY = I.IngestConfig(input_path="documents.parquet", min_text_length=1,
                          normalize_text=False, filter_code=False, id_method="md5")


@query("optional_url", """
    SELECT md5(text) AS doc_id, NULL::varchar AS url FROM documents
    UNION ALL SELECT md5(html), url FROM pages""")
def optional_url(spark, sf_dir):
    """Ingesting a source without and one with urls."""
    pages = table(spark, sf_dir, "pages", "html", "url").withColumnRenamed("html", "text")
    return I.ingest(documents(spark, sf_dir), RAW_ONLY).unionByName(I.ingest(pages, RAW_ONLY)).select("doc_id", "url")


@query("require_text", """
    SELECT 'documents' AS input, count(*) AS docs FROM documents WHERE length(text) > 0
    UNION ALL SELECT 'pages', 0""")
def require_text(spark, sf_dir):
    """Documents per ingested table; ``pages`` has no text column and gives none."""
    def counted(name):
        out = I.ingest(table(spark, sf_dir, name), RAW_ONLY)
        return out.agg(F.lit(name).alias("input"), F.count("*").alias("docs"))

    return counted("documents").unionByName(counted("pages"))


@query("missing_column_policy", """
    SELECT step, CASE WHEN step IN ('ingest', 'tokenize') THEN 0 ELSE count(*) END AS docs
    FROM documents, (VALUES ('ingest'), ('quality_filter'), ('dedup_exact'), ('dedup_fuzzy'), ('tokenize')) s(step)
    GROUP BY step""")
def missing_column_policy(spark, sf_dir):
    """Rows that each step gives for documents without the column it works on."""
    docs = documents(spark, sf_dir, "doc_id", "lang")
    steps = {
        "ingest": I.ingest(docs), "quality_filter": Q.quality_filter(docs),
        "dedup_exact": D.dedup_exact(docs, ["lang"], "content_id"), "dedup_fuzzy": D.dedup_fuzzy(docs, ["doc_id"]),
        "tokenize": tokenize(docs)}
    counts = [df.agg(F.lit(step).alias("step"), F.count("*").alias("docs")) for step, df in steps.items()]
    return reduce(DataFrame.unionByName, counts)


@query("batch_inference", "SELECT doc_id, length(text)::double AS score FROM documents")
def batch_inference(spark, sf_dir):
    """A model called for eight texts at a time; here it measures them."""
    scorer = batch_scorer(lambda: len, lambda model, texts: [(float(model(t)),) for t in texts],
                          "score double", batch_size=8)
    return documents(spark, sf_dir).select("doc_id", scorer(F.col("text"))["score"].alias("score"))


# whole numbers over eight, so that sums are exact in any order
_WEIGHTS = [(7 * i % 17 - 8) / 8 for i in range(26)]
_LETTERS = " + ".join(f"{w}::double * (length(text) - length(replace(text, '{c}', '')))" for c, w in zip(LetterModel.LETTERS, _WEIGHTS))


@query("batch_inference_matrix", f"SELECT doc_id, {_LETTERS} AS score FROM documents")
def batch_inference_matrix(spark, sf_dir):
    """A model of matrices over padded texts, called for at most 200,000 padded characters at a time."""
    scorer = batch_scorer(lambda: LetterModel(_WEIGHTS), lambda model, texts: model(texts), "score double", max_chars=200_000)
    return documents(spark, sf_dir).select("doc_id", scorer(F.col("text"))["score"].alias("score"))


@query("source_tag", "SELECT 'documents.parquet' AS source, count(*) AS docs FROM documents")
def source_tag(spark, sf_dir):
    return I.ingest(documents(spark, sf_dir), RAW_ONLY).groupBy("source").agg(F.count("*").alias("docs"))


@query("ingest_time", "SELECT 1::bigint AS times, true AS plausible")
def ingest_time(spark, sf_dir):
    """One time for all rows, in seconds of this century."""
    return I.ingest(documents(spark, sf_dir), RAW_ONLY).agg(
        F.countDistinct("ingest_time").alias("times"),
        F.coalesce(F.min(F.col("ingest_time").between(9.4e8, 4.2e9)), F.lit(True)).alias("plausible"))


@query("cast_schema", """
    SELECT doc_id::varchar AS doc_id, text, NULL::varchar AS url, n_chars::bigint AS char_count,
           (n_chars % 7)::bigint AS word_count, source, n_chars::double AS ingest_time FROM documents""")
def cast_schema(spark, sf_dir):
    """A frame of other types cast to the fixed schema; extra columns go."""
    return I.cast_ingested(documents(spark, sf_dir, "doc_id", "text", "source", "n_chars", "lang").select(
        "doc_id", "text", F.lit(None).alias("url"), F.col("n_chars").cast("int").alias("char_count"),
        (F.col("n_chars") % 7).cast("smallint").alias("word_count"), "source",
        F.col("n_chars").cast("decimal(12,0)").alias("ingest_time"), "lang"))


_INGEST = f"""
    SELECT md5(t) AS doc_id, t AS text, url, length(t)::bigint AS char_count,
           {S.words('t')}::bigint AS word_count, 'corpus' AS source
    FROM (SELECT {S.tidy('text')} AS t, NULL::varchar AS url FROM documents
          UNION ALL
          SELECT {S.tidy(S.unescape(S.unescape(S.html_text('html'), True), True))}, url FROM pages)
    WHERE length(t) >= 100 AND NOT {S.is_code('t')}"""


@query("ingest", _INGEST)
def ingest(spark, sf_dir):
    """The whole step over prose and raw pages; the time column is left out."""
    pages = table(spark, sf_dir, "pages", "html", "url").withColumnRenamed("html", "text")
    raw = documents(spark, sf_dir, "text").unionByName(pages, allowMissingColumns=True)
    return I.ingest(raw, I.IngestConfig(input_path="in/corpus", id_method="md5")).drop("ingest_time")


# ---------------------------------------------------------------------------- language

text_query("lang_sample", language.sample, S.quarter("text"))
text_query("lang_sample_head", lambda t: language.sample(t, strategy="head"), S.head("text"))
text_query("lang_model_text", lambda t: language.model_text(language.sample(t)), S.model_text(S.quarter("text")))

_LANG = S.language("(SELECT doc_id, text FROM documents)")


def _predicted(spark, sf_dir):
    df = documents(spark, sf_dir)
    return I.computed_once(df, _lang=language.predict(F.col("text")))


@query("predict_language", f"SELECT doc_id, label, round(score, 9) AS score FROM ({_LANG})")
def predict_language(spark, sf_dir):
    return _predicted(spark, sf_dir).select(
        "doc_id", F.col("_lang.label").alias("label"), F.round("_lang.score", 9).alias("score"))


@query("strip_label_prefix", f"SELECT doc_id, replace(label, '__label__', '') AS lang FROM ({_LANG})")
def strip_label_prefix(spark, sf_dir):
    return _predicted(spark, sf_dir).select("doc_id", language.strip_label(F.col("_lang.label")).alias("lang"))


@query("filter_language", f"SELECT doc_id FROM ({_LANG}) WHERE label = '__label__en' AND score > 0.65")
def filter_language(spark, sf_dir):
    return _predicted(spark, sf_dir).where(Q.is_language(F.col("_lang"), "__label__en", 0.65)).select("doc_id")


# ----------------------------------------------------------------------- personal data

text_query("redact_email", lambda t: pii.redact(t, "email"), S.rx("text", P.EMAIL, "'<EMAIL>'"))
text_query("redact_ip", lambda t: pii.redact(t, "ip"), S.rx("text", P.IPV4, "'<IP>'"))
text_query("redact_phone", lambda t: pii.redact(t, "phone"), S.rx("text", P.PHONE, "'<PHONE>'"))


@query("redact_pii", f"SELECT doc_id, {S.redact('text')} AS text, {S.redact('text')} <> text AS has_pii FROM documents")
def redact_pii(spark, sf_dir):
    return I.computed_once(documents(spark, sf_dir), redacted=pii.redact(F.col("text"))).select(
        "doc_id", F.col("redacted").alias("text"), (F.col("redacted") != F.col("text")).alias("has_pii"))


@query("drop_pii", " AND ".join([
    f"SELECT doc_id FROM documents WHERE {S.hits('text', P.EMAIL)} = 0",
    f"{S.hits('text', P.IPV4)} = 0", f"{S.hits('text', P.PHONE)} = 0"]))
def drop_pii(spark, sf_dir):
    return documents(spark, sf_dir).where(~pii.has_pii(F.col("text"))).select("doc_id")


# ---------------------------------------------------------------------------- toxicity

text_query("toxic_hits", lambda t: toxicity.hits(t, S.LEXICON), f"{S.whole_words('text', S.LEXICON)}::bigint")
text_query("toxic_ratio", lambda t: F.round(toxicity.ratio(t, S.LEXICON), 9),
           f"round({S.whole_words('text', S.LEXICON)}::double / nullif({S.words('text')}, 0), 9)")


@query("filter_toxic", f"SELECT doc_id FROM documents WHERE NOT {S.toxic('text')}")
def filter_toxic(spark, sf_dir):
    return documents(spark, sf_dir).where(~toxicity.is_toxic(F.col("text"), S.LEXICON)).select("doc_id")


# ----------------------------------------------------------------------------- quality

text_query("punc_ratio", lambda t: F.round(X.punc_ratio(t), 9), f"round({S.punc('text')}, 9)")


@query("filter_punc", f"SELECT doc_id FROM documents WHERE {S.punc('text')} <= 0.3")
def filter_punc(spark, sf_dir):
    return documents(spark, sf_dir).where(X.punc_ratio(F.col("text")) <= 0.3).select("doc_id")


CHECKS = Q.FilterConfig(toxic_words=S.LEXICON)


def filtered_sql(source: str, keep: str = "*") -> str:
    """Rows of ``source`` that pass the quality filter, with redacted text."""
    return f"""
    SELECT {keep} REPLACE ({S.redact('text')} AS text)
    FROM (SELECT * EXCLUDE (label, score) FROM ({S.language(source)})
          WHERE label = '__label__en' AND score > 0.65)
    WHERE NOT {S.toxic('text')} AND {S.punc(S.redact('text'))} <= 0.3"""


@query("quality_filter", filtered_sql("(SELECT doc_id, text FROM documents)"))
def quality_filter(spark, sf_dir):
    return Q.quality_filter(documents(spark, sf_dir), CHECKS)


@query("annotate_quality", f"""
    SELECT doc_id, label AS lang_label, round(score, 9) AS lang_score,
           {S.whole_words('text', S.LEXICON)}::bigint AS toxic_hits,
           coalesce(round({S.whole_words('text', S.LEXICON)}::double / nullif({S.words('text')}, 0), 9), 0) AS toxic_ratio,
           {S.redact('text')} <> text AS has_pii, round({S.punc(S.redact('text'))}, 9) AS punc_ratio
    FROM ({_LANG})""")
def annotate_quality(spark, sf_dir):
    scored = Q.annotate_quality(documents(spark, sf_dir), CHECKS).drop("text")
    return scored.withColumns({c: F.round(c, 9) for c in ("lang_score", "toxic_ratio", "punc_ratio")})


# ------------------------------------------------------------- input and output sides


def sides(spark, sf_dir):
    """Input: all documents. Output: those of 100 characters and more, redacted."""
    docs = documents(spark, sf_dir)
    return pair(docs, I.computed_once(docs.where(I.long_enough(F.col("text"), 100)), text=pii.redact(F.col("text"))))


SIDES_SQL = f"""(
    SELECT 'input' AS side, doc_id, text FROM documents UNION ALL
    SELECT 'output', doc_id, {S.redact('text')} FROM documents WHERE length(text) >= 100)"""
