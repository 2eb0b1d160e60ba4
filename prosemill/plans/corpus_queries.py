"""Queries over whole corpora: files, deduplication, tokens, runs."""

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions import minhash as M
from ..functions import text as X
from ..operators import dedup as D
from ..operators import tokenize as T
from ..operators.ingest import IngestConfig, computed_once
from ..operators.perplexity import words
from ..operators.quality import FilterConfig
from ..operators.report import retention as with_retention
from ..operators.report import stage_funnel as funnel
from ..sources import jsonl as J
from ..sources.storage import output_bytes, scratch_path, stage
from ..sources.tokens import write_tokens
from ..streaming.dedup_stream import dedup_exact_stream as stream_dedup
from ..streaming.dedup_stream import run_available
from . import oracle_sql as S
from .config import RunConfig, from_dict
from .corpus_run import prepare
from .registry import documents, query, table
from .row_queries import CHECKS, filtered_sql

DOC_SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"

# ----------------------------------------------------------------------------- files


def _as_jsonl(spark, df, name):
    path = scratch_path(spark, name)
    J.write_jsonl(df, path)
    return path


@query("read_jsonl", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def read_jsonl(spark, sf_dir):
    """Documents written as JSON lines and read back with a fixed schema."""
    return J.read_jsonl(spark, _as_jsonl(spark, table(spark, sf_dir, "documents"), "docs"), DOC_SCHEMA)


@query("read_json_lines_raw", """
    SELECT (SELECT count(*) FROM documents) + (SELECT count(*) FROM conversations) AS lines,
           (SELECT count(*) FROM conversations WHERE NOT json_valid(replace(text, chr(10), ' '))) AS malformed""")
def read_json_lines_raw(spark, sf_dir):
    """Raw lines, of which the conversation turns are no JSON."""
    from ..operators.profile import malformed_count

    path = scratch_path(spark, "lines")
    docs = documents(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))
    talk = table(spark, sf_dir, "conversations", "text").select(F.translate("text", "\n\r", "  ").alias("value"))
    docs.unionByName(talk).write.text(path)
    return malformed_count(J.read_lines(spark, path))


@query("read_pair", """
    SELECT 'input' AS side, count(*) AS docs, sum(length(text))::bigint AS chars FROM documents
    UNION ALL SELECT 'output', count(*), sum(length(text))::bigint FROM documents WHERE lang = 'en'""")
def read_pair(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    both = J.read_pair(spark, _as_jsonl(spark, docs, "raw"), _as_jsonl(spark, docs.where("lang = 'en'"), "cleaned"))
    return both.groupBy("side").agg(F.count("*").alias("docs"), F.sum(F.length("text")).alias("chars"))


def _export(spark, sf_dir):
    return J.export_columns(documents(spark, sf_dir, "doc_id", "text", "lang", "source"))


@query("export_projection", "SELECT doc_id, text, source FROM documents")
def export_projection(spark, sf_dir):
    return _export(spark, sf_dir)


@query("write_jsonl_sharded", "SELECT doc_id, text, source FROM documents")
def write_jsonl_sharded(spark, sf_dir):
    path = _as_jsonl(spark, _export(spark, sf_dir), "shards")
    return J.read_jsonl(spark, path, "doc_id BIGINT, text STRING, source STRING")


@query("write_jsonl_single", "SELECT doc_id, text, source FROM documents")
def write_jsonl_single(spark, sf_dir):
    path = J.write_jsonl_single(_export(spark, sf_dir), scratch_path(spark, "single") + ".jsonl", ("doc_id",))
    return J.read_jsonl(spark, path, "doc_id BIGINT, text STRING, source STRING")


@query("overwrite_output", "SELECT doc_id, text FROM documents WHERE lang = 'en'")
def overwrite_output(spark, sf_dir):
    """A second export to the same place replaces the first."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    path = _as_jsonl(spark, docs.select("doc_id", "text"), "again")
    J.write_jsonl(docs.where("lang = 'en'").select("doc_id", "text"), path)
    return J.read_jsonl(spark, path, "doc_id BIGINT, text STRING")


@query("output_size", """
    SELECT sum(strlen(to_json({'doc_id': doc_id, 'text': text, 'source': source})) + 1)::bigint AS bytes
    FROM documents""")
def output_size(spark, sf_dir):
    size = output_bytes(spark, _as_jsonl(spark, _export(spark, sf_dir), "sized"))
    return spark.range(1).select(F.lit(size).cast("bigint").alias("bytes"))


# ---------------------------------------------------------------------- deduplication

MD5 = D.DedupConfig(family="md5")


def _copies(spark, sf_dir):
    return documents(spark, sf_dir).select(F.md5("text").alias("content_id"), "doc_id", "text")


_UNIQUE = """(SELECT doc_id, text FROM (
    SELECT doc_id, text, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS n FROM documents) WHERE n = 1)"""


def _unique(spark, sf_dir):
    return stage(D.dedup_exact(_copies(spark, sf_dir), ["doc_id"], "content_id").select("doc_id", "text"), "unique")


@query("dedup_exact", f"SELECT md5(text) AS content_id, doc_id, text FROM {_UNIQUE}")
def dedup_exact(spark, sf_dir):
    return D.dedup_exact(_copies(spark, sf_dir), ["doc_id"], "content_id")


@query("dedup_exact_stream", "SELECT DISTINCT md5(text) AS content_id FROM documents")
def dedup_exact_stream(spark, sf_dir):
    """The ids that survive when the documents arrive as a stream."""
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    # as a glob, so that one file and a folder of files both work
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]")
    path = scratch_path(spark, "stream")
    run_available(
        stream_dedup(stream.select(F.md5("text").alias("content_id")), "content_id"), path, f"{path}-state")
    return spark.read.parquet(path)


@query("shingles", f"""
    SELECT d.doc_id, count(gram) AS n, md5(coalesce(string_agg(gram, '|' ORDER BY gram), '')) AS digest
    FROM documents d LEFT JOIN ({S.shingles('documents')}) s ON d.doc_id = s.doc_id GROUP BY d.doc_id""")
def shingles(spark, sf_dir):
    """Number of shingles and a digest of the sorted set."""
    return documents(spark, sf_dir).select("doc_id", X.shingles(F.col("text")).alias("s")).select(
        "doc_id", F.size("s").cast("bigint").alias("n"), F.md5(F.array_join(F.array_sort("s"), "|")).alias("digest"))


@query("minhash_signature", f"""
    SELECT doc_id, string_agg(value::varchar, ',' ORDER BY i) AS signature
    FROM ({S.signatures('documents')}) GROUP BY doc_id""")
def minhash_signature(spark, sf_dir):
    hashed = computed_once(documents(spark, sf_dir), h=M.shingle_hashes(F.col("text"), family="md5"))
    return hashed.select("doc_id", M.minhash(family="md5")("h").alias("s")).where("s IS NOT NULL").select(
        "doc_id", F.array_join(F.col("s").cast("array<string>"), ",").alias("signature"))


@query("lsh_buckets", f"""
    SELECT bucket, count(*) AS docs, min(doc_id) AS first_doc
    FROM ({S.buckets('documents', 8, 16)}) GROUP BY bucket""")
def lsh_buckets(spark, sf_dir):
    bands = D.band_table(documents(spark, sf_dir), ["doc_id"], MD5)
    return bands.select("doc_id", F.explode("buckets").alias("key")).groupBy("key").agg(
        F.count("*").alias("docs"), F.min("doc_id").alias("first_doc"),
    ).select(F.lower(F.hex("key")).alias("bucket"), "docs", "first_doc")


def _fuzzy_sql(**options) -> str:
    return f"""WITH RECURSIVE uniq AS MATERIALIZED {_UNIQUE}, {S.walk('uniq', **options)}
    SELECT doc_id FROM uniq WHERE doc_id NOT IN (SELECT doc_id FROM seen WHERE NOT is_kept)"""


@query("dedup_fuzzy", _fuzzy_sql())
def dedup_fuzzy(spark, sf_dir):
    """The SQL walks through the documents one by one."""
    return D.dedup_fuzzy(_unique(spark, sf_dir), ["doc_id"], MD5).select("doc_id")


LOOSE = D.DedupConfig(family="md5", threshold=0.7, num_perm=64, ngram_size=2)


@query("dedup_fuzzy_loose", _fuzzy_sql(
    bands=LOOSE.bands()[0], rows=LOOSE.bands()[1], num_perm=LOOSE.num_perm, size=LOOSE.ngram_size))
def dedup_fuzzy_loose(spark, sf_dir):
    """Short n-grams and a low threshold: many collisions."""
    return D.dedup_fuzzy(_unique(spark, sf_dir), ["doc_id"], LOOSE).select("doc_id")


@query("dedup_fuzzy_sha1", _fuzzy_sql(family="sha1"))
def dedup_fuzzy_sha1(spark, sf_dir):
    """With the default hash family."""
    return D.dedup_fuzzy(_unique(spark, sf_dir), ["doc_id"]).select("doc_id")


@query("dedup_fuzzy_xxhash64", "SELECT count(*) AS docs, true AS near_sha1 FROM (SELECT DISTINCT md5(text) FROM documents)")
def dedup_fuzzy_xxhash64(spark, sf_dir):
    """With the native hash family: SQL has no such hash, so it is held against the default family,
    whose survivors differ by chance only, by less than one in a hundred."""
    unique = _unique(spark, sf_dir)
    kept = [D.dedup_fuzzy(unique, ["doc_id"], D.DedupConfig(family=f)).select("doc_id", F.lit(f).alias("family")) for f in ("xxhash64", "sha1")]
    each = kept[0].unionByName(kept[1]).groupBy("doc_id").agg(F.count("*").alias("n"))
    off = each.agg(F.count_if(F.col("n") == 1).alias("off"))
    return unique.agg(F.count("*").alias("docs")).select("docs", (F.lit(off.first()["off"]) * 100 <= F.col("docs")).alias("near_sha1"))


_LOOSE_SQL = {"bands": LOOSE.bands()[0], "rows": LOOSE.bands()[1], "num_perm": LOOSE.num_perm, "size": LOOSE.ngram_size}


@query("dedup_capacity", _fuzzy_sql(**_LOOSE_SQL))
def dedup_capacity(spark, sf_dir):
    """A configured index capacity has no effect: all documents are compared."""
    import warnings

    section = {"max_lsh_items": 10, "family": LOOSE.family, "threshold": LOOSE.threshold,
               "num_perm": LOOSE.num_perm, "ngram_size": LOOSE.ngram_size}
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        cfg = from_dict({"ingestion": {"input_path": "in"}, "deduplication": section}).deduplication
    return D.dedup_fuzzy(_unique(spark, sf_dir), ["doc_id"], cfg).select("doc_id")


def _verified_sql(threshold: float, **options) -> str:
    return f"""WITH RECURSIVE uniq AS MATERIALIZED {_UNIQUE}, {S.verified_walk('uniq', threshold, **options)}
    SELECT doc_id FROM uniq WHERE doc_id NOT IN (SELECT doc_id FROM seen WHERE NOT is_kept)"""


@query("dedup_fuzzy_verified", _verified_sql(MD5.threshold))
def dedup_fuzzy_verified(spark, sf_dir):
    """Bucket hits count only if the shingle sets are similar enough."""
    return D.dedup_fuzzy(_unique(spark, sf_dir), ["doc_id"], D.DedupConfig(family="md5", verify=True)).select("doc_id")


@query("dedup_fuzzy_loose_verified", _verified_sql(LOOSE.threshold, **_LOOSE_SQL))
def dedup_fuzzy_loose_verified(spark, sf_dir):
    """Many collisions, most of them of texts that are not similar."""
    return D.dedup_fuzzy(_unique(spark, sf_dir), ["doc_id"], replace(LOOSE, verify=True)).select("doc_id")


@query("near_dup_pairs", f"""
    WITH RECURSIVE uniq AS MATERIALIZED {_UNIQUE}, {S.walk('uniq', **_LOOSE_SQL)},
    lists AS MATERIALIZED ({S.shingle_lists('uniq', LOOSE.ngram_size)})
    SELECT doc, kept_doc, round({S.jaccard('x.grams', 'y.grams')}, 9) AS jaccard FROM (
    SELECT l.doc_id AS doc, min(k.doc_id) AS kept_doc
    FROM bucketed l JOIN bucketed k USING (bucket)
    WHERE l.doc_id IN (SELECT doc_id FROM seen WHERE NOT is_kept)
      AND k.doc_id IN (SELECT doc_id FROM seen WHERE is_kept) AND k.doc_id < l.doc_id
    GROUP BY l.doc_id) JOIN lists x ON x.doc_id = doc JOIN lists y ON y.doc_id = kept_doc""")
def near_dup_pairs(spark, sf_dir):
    """Each dropped document with the first kept one of a common bucket, and their similarity."""
    return D.near_dup_matches(_unique(spark, sf_dir), ["doc_id"], LOOSE).withColumn("jaccard", F.round("jaccard", 9))


@query("dedup_empty_passthrough", "SELECT doc_id FROM documents")
def dedup_empty_passthrough(spark, sf_dir):
    """Texts reduced to their punctuation have no shingles: all pass, equal or not."""
    bare = documents(spark, sf_dir).withColumn("text", F.regexp_replace("text", r"[\p{L}\p{N}_\s]", ""))
    return D.dedup_fuzzy(bare, ["doc_id"], MD5).select("doc_id")


@query("dedup", f"""
    WITH RECURSIVE uniq AS MATERIALIZED {_UNIQUE}, {S.walk('uniq')}
    SELECT md5(text) AS content_id, doc_id FROM uniq
    WHERE doc_id NOT IN (SELECT doc_id FROM seen WHERE NOT is_kept)""")
def dedup(spark, sf_dir):
    """Exact and fuzzy in one plan."""
    return D.dedup(_copies(spark, sf_dir), ["doc_id"], MD5, "content_id").select("content_id", "doc_id")


# ----------------------------------------------------------------------------- tokens


def _ranks() -> str | None:
    """A rank file installed with the tokenizer library's data, if there is one."""
    try:
        import public_tokenizers

        return public_tokenizers.path("byte_bpe_50k.tiktoken")
    except ImportError:
        return None


def _tokens(spark, sf_dir, **options):
    """Tokens of the built-in word tokenizer, which SQL can state."""
    docs = documents(spark, sf_dir, "doc_id", "text", "source")
    return T.tokenize(docs, T.TokenizeConfig(tokenizer_model=T.WORDS, **options))


@query("tokenize", "SELECT doc_id, text AS decoded, true AS counted FROM documents")
def tokenize(spark, sf_dir):
    """Byte-level ids of whole texts, decoded again."""
    cfg = T.TokenizeConfig(ranks_path=_ranks(), special="as_text")
    tokens = T.tokenize(documents(spark, sf_dir, "doc_id", "text", "source"), cfg)
    return tokens.select("doc_id", T.decode_udf(cfg)("input_ids").alias("decoded"),
                         (F.col("token_count") == F.size("input_ids")).alias("counted"))


_WORDS = "list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')"
_IDS = f"array_to_string(list_transform({_WORDS}, lambda x: {S.md5_int('x')}), ',')"


@query("token_projection", f"SELECT doc_id, len({_WORDS})::bigint AS token_count, source, text FROM documents")
def token_projection(spark, sf_dir):
    return _tokens(spark, sf_dir, keep_text=True).drop("input_ids")


@query("token_anomalies", """
    SELECT count(*) AS docs, count(*) FILTER (WHERE lang = 'fr') AS empty_docs, count(*) FILTER (WHERE lang = 'de') AS failed_docs
    FROM documents""")
def token_anomalies(spark, sf_dir):
    """French texts emptied, German ones with a special-token string, which fails them."""
    udf = T.encode_udf(T.TokenizeConfig(ranks_path=_ranks()))
    text = F.when(F.col("lang") == "fr", "").when(F.col("lang") == "de", F.concat("text", F.lit(T.END_OF_TEXT))).otherwise(F.col("text"))
    counts = documents(spark, sf_dir, "text", "lang").select(udf(text).alias("t")).agg(
        *T.anomaly_counts(F.col("t.ids"), F.col("t.error")))
    return counts.select("docs", "empty_docs", "failed_docs")


@query("token_specials", """
    SELECT policy, count(*) AS docs, CASE WHEN policy = 'error_empty' THEN count(*) ELSE 0 END AS empty_docs
    FROM documents, (VALUES ('as_text'), ('error_empty'), ('parse')) p(policy) GROUP BY policy""")
def token_specials(spark, sf_dir):
    """Texts with a special-token string appended, under each policy; failed rows stay."""
    policies = {"error_empty": {}, "as_text": {"special": "as_text"}, "parse": {"parse_special": True}}
    docs = documents(spark, sf_dir).withColumn("text", F.concat("text", F.lit(T.END_OF_TEXT)))
    counts = None
    for policy, options in policies.items():
        out = T.tokenize(docs, T.TokenizeConfig(ranks_path=_ranks(), **options)).agg(
            F.lit(policy).alias("policy"), F.count("*").alias("docs"),
            F.count_if(F.col("token_count") == 0).alias("empty_docs"))
        counts = out if counts is None else counts.unionByName(out)
    return counts


@query("truncate_tokens", f"SELECT doc_id, array_to_string({_WORDS}[1:64], ' ') AS kept FROM documents")
def truncate_tokens(spark, sf_dir):
    """Truncation, on whitespace words."""
    return documents(spark, sf_dir).select("doc_id", F.array_join(T.truncate(words(F.col("text")), 64), " ").alias("kept"))


@query("token_count", f"SELECT doc_id, len({_WORDS}[1:64])::bigint AS token_count FROM documents")
def token_count(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", F.size(T.truncate(words(F.col("text")), 64)).cast("bigint").alias("token_count"))


def _written_tokens(spark, sf_dir, export_format):
    path = scratch_path(spark, "tokens")
    df = _tokens(spark, sf_dir)
    write_tokens(df, path, export_format)
    back = spark.read.parquet(path) if export_format == "parquet" else spark.read.schema(df.schema).json(path)
    return back.select("doc_id", "token_count", "source", F.array_join(F.col("input_ids").cast("array<string>"), ",").alias("ids"))


_WRITTEN = f"SELECT doc_id, len({_WORDS})::bigint AS token_count, source, {_IDS} AS ids FROM documents"


@query("write_tokens_parquet", _WRITTEN)
def write_tokens_parquet(spark, sf_dir):
    return _written_tokens(spark, sf_dir, "parquet")


@query("write_tokens_jsonl", _WRITTEN)
def write_tokens_jsonl(spark, sf_dir):
    return _written_tokens(spark, sf_dir, "jsonl")


@query("tokenization_step", f"SELECT doc_id, len({_WORDS})::bigint AS token_count, source FROM documents")
def tokenization_step(spark, sf_dir):
    path = T.run_tokenization(
        documents(spark, sf_dir, "doc_id", "text", "source"),
        T.TokenizeConfig(tokenizer_model=T.WORDS), scratch_path(spark, "step"))
    return spark.read.parquet(path).select("doc_id", "token_count", "source")


# ----------------------------------------------------------------------- counts and runs

STAGES = ("input", "ingested", "filtered", "deduplicated")
RUN = RunConfig(
    ingestion=IngestConfig(input_path="in/corpus", id_method="md5"), filtering=CHECKS, deduplication=MD5)

_RUN_CTES = f"""WITH RECURSIVE
    ingested AS MATERIALIZED (
      SELECT md5(t) AS doc_id, t AS text FROM (SELECT {S.tidy('text')} AS t FROM documents)
      WHERE length(t) >= 100 AND NOT {S.is_code('t')}),
    filtered AS MATERIALIZED ({filtered_sql('ingested')}),
    uniq AS MATERIALIZED (
      SELECT doc_id, any_value(text) AS text FROM filtered GROUP BY doc_id),
    {S.walk('uniq')},
    final AS MATERIALIZED (
      SELECT * FROM uniq WHERE doc_id NOT IN (SELECT doc_id FROM seen WHERE NOT is_kept)),
    counts AS (
      SELECT (SELECT count(*) FROM documents) AS input, (SELECT count(*) FROM ingested) AS ingested,
             (SELECT count(*) FROM filtered) AS filtered, (SELECT count(*) FROM final) AS deduplicated)"""


@query("corpus_run", f"{_RUN_CTES} SELECT doc_id, text, 'corpus' AS source FROM final")
def corpus_run(spark, sf_dir):
    """The whole run up to the export: cleaned, filtered, deduplicated documents."""
    return J.export_columns(prepare(documents(spark, sf_dir, "text"), RUN)).drop("url")


def _counts(spark, sf_dir):
    counts = {}
    raw = documents(spark, sf_dir, "text")
    prepare(raw, RUN, counts)
    return raw.agg(F.count("*").alias("input"), *[F.lit(counts[s]).cast("bigint").alias(s) for s in STAGES[1:]])


@query("stage_counts", f"{_RUN_CTES} SELECT * FROM counts")
def stage_counts(spark, sf_dir):
    """Counts observed while the run writes its result."""
    return _counts(spark, sf_dir)


@query("ingest_malformed", f"""
    SELECT (SELECT count(*) FROM conversations WHERE NOT json_valid(replace(text, chr(10), ' '))) AS malformed,
           (SELECT count(*) FROM (SELECT {S.tidy('text')} AS t FROM documents) WHERE length(t) >= 100 AND NOT {S.is_code('t')}) AS ingested""")
def ingest_malformed(spark, sf_dir):
    """Documents as JSON lines among lines that are none: a run counts both."""
    path, counts = scratch_path(spark, "mixed"), {}
    docs = documents(spark, sf_dir, "text").select(F.to_json(F.struct("*")).alias("value"))
    talk = table(spark, sf_dir, "conversations", "text").select(F.translate("text", "\n\r", "  ").alias("value"))
    docs.unionByName(talk).write.text(path)
    alone = RunConfig(ingestion=IngestConfig(input_path="in/corpus", id_method="md5"),
                      filtering=FilterConfig(enabled=False), deduplication=D.DedupConfig(enabled=False))
    prepare(J.read_jsonl(spark, path, with_corrupt=True), alone, counts)
    return spark.range(1).select(*[F.lit(counts[k]).cast("bigint").alias(k) for k in ("malformed", "ingested")])


@query("retention", f"""{_RUN_CTES}
    SELECT ingested, deduplicated, round(deduplicated * 100.0::double / ingested, 4) AS retention_pct FROM counts""")
def retention(spark, sf_dir):
    return with_retention(_counts(spark, sf_dir), "ingested", "deduplicated").select(
        "ingested", "deduplicated", "retention_pct")


@query("stage_funnel", f"""{_RUN_CTES}
    SELECT step, stage, docs, round(docs * 100.0::double / (SELECT input FROM counts), 4) AS pct_of_input FROM (
    """ + " UNION ALL ".join(f"SELECT {i} AS step, '{s}' AS stage, {s} AS docs FROM counts" for i, s in enumerate(STAGES)) + ")")
def stage_funnel(spark, sf_dir):
    return funnel(_counts(spark, sf_dir), STAGES)
