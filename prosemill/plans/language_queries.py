"""Queries of the trained language model."""

from pyspark.sql import functions as F

from ..operators import language_model as M
from ..sources.storage import scratch_path
from . import oracle_sql as S
from .registry import documents, query

#: the part of the documents that the model of these queries does not learn from
HELD_OUT = "substr(md5(cast(doc_id AS {string})), 1, 1) IN ('0', '1', '2')"
_HELD, _HELD_SQL = HELD_OUT.format(string="STRING"), HELD_OUT.format(string="VARCHAR")

_GRAMS = f"""
    plain AS MATERIALIZED (SELECT doc_id, lang, {_HELD_SQL} AS held_out,
        trim({S.rx("lower(coalesce(text, ''))", "[^" + chr(92) + "p{L}]+", "' '")}) AS t FROM documents),
    grams AS MATERIALIZED (SELECT doc_id, lang, held_out, unnest(list_transform(range(0, len(c)::bigint - 2),
        lambda i: c[i + 1] || c[i + 2] || c[i + 3])) AS gram
        FROM (SELECT doc_id, lang, held_out, string_split(' ' || t || ' ', '') AS c FROM plain WHERE t <> '')),
    model AS MATERIALIZED (SELECT lang, gram, count(*) AS n FROM grams WHERE NOT held_out AND lang IS NOT NULL GROUP BY lang, gram)"""

_PREDICTED = f"""{_GRAMS},
    langs AS MATERIALIZED (SELECT lang, ln(count(*)::double / sum(count(*)) OVER ()) AS prior,
        (SELECT coalesce(sum(n), 0) FROM model m WHERE m.lang = d.lang)::double + 0.5::double * (SELECT count(DISTINCT gram) FROM model) AS below
        FROM documents d WHERE lang IS NOT NULL AND NOT {_HELD_SQL} GROUP BY lang),
    scores AS MATERIALIZED (SELECT g.doc_id, l.lang, l.prior + sum(g.n * ln((coalesce(m.n, 0) + 0.5::double) / l.below)) AS s
        FROM (SELECT doc_id, gram, count(*) AS n FROM grams GROUP BY doc_id, gram) g CROSS JOIN langs l
        LEFT JOIN model m ON m.lang = l.lang AND m.gram = g.gram GROUP BY g.doc_id, l.lang, l.prior),
    found AS (SELECT doc_id, '__label__' || arg_max(lang, s) AS label, 1 / sum(exp(s - best)) AS score
        FROM (SELECT *, max(s) OVER (PARTITION BY doc_id) AS best FROM scores) GROUP BY doc_id),
    predicted AS (SELECT d.doc_id, coalesce(label, '__label__unknown') AS label, coalesce(score, 0.0::double) AS score
        FROM documents d LEFT JOIN found USING (doc_id))"""


def _training(spark, sf_dir):
    return documents(spark, sf_dir, "doc_id", "text", "lang").where(f"NOT {_HELD}")


def _model(spark, sf_dir):
    return M.train_language_model(_training(spark, sf_dir), scratch_path(spark, "languages"))


def _predicted(spark, sf_dir, **options):
    return M.predict_language(documents(spark, sf_dir), _model(spark, sf_dir), **options)


@query("language_model_counts", f"WITH {_GRAMS} SELECT lang, gram, n FROM model")
def language_model_counts(spark, sf_dir):
    """The counts of the model: n-grams by language."""
    return M.gram_counts(_training(spark, sf_dir))


@query("language_model", f"""WITH {_GRAMS}, langs AS (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL AND NOT {_HELD_SQL})
    SELECT gram, string_agg(coalesce(n, 0)::varchar, ',' ORDER BY lang) AS counts
    FROM (SELECT DISTINCT gram FROM model) CROSS JOIN langs LEFT JOIN model USING (gram, lang) GROUP BY gram""")
def language_model(spark, sf_dir):
    """The model as it is read back from its files."""
    return _model(spark, sf_dir).grams.select("gram", F.array_join(F.col("counts").cast("array<string>"), ",").alias("counts"))


_TRAINED = f"WITH {_PREDICTED} SELECT doc_id, label, round(score, 6) AS score FROM predicted"


@query("predict_language_trained", _TRAINED)
def predict_language_trained(spark, sf_dir):
    """Every document, scored with the model as a broadcast table."""
    return _predicted(spark, sf_dir).select("doc_id", "label", F.round("score", 6).alias("score"))


@query("predict_language_joined", _TRAINED)
def predict_language_joined(spark, sf_dir):
    """The same with a model that is too large to broadcast."""
    return _predicted(spark, sf_dir, broadcast_grams=0).select("doc_id", "label", F.round("score", 6).alias("score"))


@query("language_agreement", f"""WITH {_PREDICTED}
    SELECT {_HELD_SQL} AS held_out, lang, count(*) AS docs, count(*) FILTER (WHERE label = '__label__' || lang) AS agree,
        round(count(*) FILTER (WHERE label = '__label__' || lang) * 100.0::double / count(*), 4) AS pct
    FROM predicted JOIN documents USING (doc_id) GROUP BY held_out, lang""")
def language_agreement(spark, sf_dir):
    """How often the prediction is the language given, for rows learned from and rows held out."""
    given = documents(spark, sf_dir, "doc_id", "lang").withColumn("held_out", F.expr(_HELD))
    agree = F.count_if(F.col("label") == F.concat(F.lit("__label__"), "lang"))
    return _predicted(spark, sf_dir).join(given, "doc_id").groupBy("held_out", "lang").agg(
        F.count("*").alias("docs"), agree.alias("agree"), F.round(agree * F.lit(100.0) / F.count("*"), 4).alias("pct"))


@query("filter_language_trained", f"WITH {_PREDICTED} SELECT doc_id, text FROM documents JOIN predicted USING (doc_id) WHERE label = '__label__en' AND score > 0.65")
def filter_language_trained(spark, sf_dir):
    return M.filter_language(documents(spark, sf_dir), _model(spark, sf_dir), "__label__en", 0.65)
