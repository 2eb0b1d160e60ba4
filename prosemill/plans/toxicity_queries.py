"""Queries of the learned toxicity model and of large lexicons."""

from pyspark.sql import functions as F

from ..functions import patterns as P
from ..operators import toxicity_model as M
from ..sources.storage import scratch_path
from . import oracle_sql as S
from .language_queries import HELD_OUT
from .registry import documents, query, table

_HELD, _HELD_SQL = HELD_OUT.format(string="STRING"), HELD_OUT.format(string="VARCHAR")
_SPLIT = f"list_filter(string_split_regex(lower(coalesce(text, '')), {S.lit('[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_]+')}), lambda x: x <> '')"

_COUNTED = f"""
    words AS MATERIALIZED (SELECT doc_id, unnest({_SPLIT}) AS word FROM documents),
    told AS MATERIALIZED (SELECT doc_id, toxic FROM labels WHERE toxic IN (0, 1) AND NOT {_HELD_SQL}),
    model AS MATERIALIZED (SELECT word, count(*) FILTER (WHERE toxic = 1) AS toxic, count(*) FILTER (WHERE toxic = 0) AS clean
        FROM words JOIN told USING (doc_id) GROUP BY word),
    odds AS MATERIALIZED (SELECT word, toxic, clean, ln((toxic + 1::double) / ((SELECT sum(toxic) FROM model) + (SELECT count(*) FROM model)))
        - ln((clean + 1::double) / ((SELECT sum(clean) FROM model) + (SELECT count(*) FROM model))) AS odds FROM model),
    prior AS (SELECT ln(count(*) FILTER (WHERE toxic = 1)::double / count(*) FILTER (WHERE toxic = 0)) AS p FROM told JOIN documents USING (doc_id)),
    scores AS MATERIALIZED (SELECT doc_id, 1 / (1 + exp(-coalesce(sum(odds), 0.0::double) - (SELECT p FROM prior))) AS score
        FROM documents LEFT JOIN words USING (doc_id) LEFT JOIN odds USING (word) GROUP BY doc_id)"""


def _model(spark, sf_dir):
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").where(f"NOT {_HELD}")
    return M.train_toxicity_model(documents(spark, sf_dir), labels, scratch_path(spark, "toxicity"))


def _scores(spark, sf_dir, **options):
    return M.score_toxicity(documents(spark, sf_dir), _model(spark, sf_dir), **options)


@query("toxicity_word_odds", f"WITH {_COUNTED} SELECT word, toxic, clean, round(odds, 6) AS odds FROM odds")
def toxicity_word_odds(spark, sf_dir):
    """The learned model: words with counts and log odds."""
    model = _model(spark, sf_dir)
    return model.words.select("word", "toxic", "clean", F.round(model.odds(), 6).alias("odds"))


_LEARNED = f"WITH {_COUNTED} SELECT doc_id, round(score, 6) AS score FROM scores"


@query("toxicity_learned", _LEARNED)
def toxicity_learned(spark, sf_dir):
    """Every document with its learned score."""
    return _scores(spark, sf_dir).select("doc_id", F.round("score", 6).alias("score"))


@query("toxicity_learned_joined", _LEARNED)
def toxicity_learned_joined(spark, sf_dir):
    """The same with a model that is too large to broadcast."""
    return _scores(spark, sf_dir, broadcast_words=0).select("doc_id", F.round("score", 6).alias("score"))


@query("toxicity_scores_learned", f"""WITH {_COUNTED}
    SELECT 'input' AS side, category, count(*) AS docs,
        CASE WHEN category = 'toxicity' THEN count(*) FILTER (WHERE score > 0.5) END AS toxic_docs,
        CASE WHEN category = 'toxicity' THEN round(count(*) FILTER (WHERE score > 0.5) * 100.0::double / count(*), 4) END AS toxic_pct
    FROM scores, (VALUES {', '.join(f"('{c}')" for c in P.TOXICITY_CATEGORIES)}) t(category) GROUP BY category""")
def toxicity_scores_learned(spark, sf_dir):
    """Toxic documents by the learned score; categories without labels are null."""
    return M.toxicity_report(_scores(spark, sf_dir).withColumn("side", F.lit("input")))


@query("toxicity_sweep", f"""WITH {_COUNTED},
    stepped AS MATERIALIZED (SELECT least(floor(score * 100), 99)::bigint AS level, l.toxic FROM scores JOIN labels l USING (doc_id) WHERE l.toxic IN (0, 1)),
    steps AS (SELECT unnest(range((SELECT max(level) + 1 FROM stepped))) AS step)
    SELECT step, step / 100.0::double AS threshold, count(*) AS predicted, sum(toxic)::bigint AS hits,
        (SELECT sum(toxic)::bigint FROM stepped) AS toxic, round(sum(toxic)::double / count(*), 6) AS precision,
        round(sum(toxic)::double / (SELECT sum(toxic) FROM stepped), 6) AS recall
    FROM steps JOIN stepped ON level >= step GROUP BY step""")
def toxicity_sweep(spark, sf_dir):
    """Precision and recall of the learned score at each threshold, against all labels."""
    return M.score_sweep(_scores(spark, sf_dir), table(spark, sf_dir, "labels", "doc_id", "toxic"))


_LEXICON = f"SELECT DISTINCT unnest({_SPLIT}) AS term FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 AND lang <> 'en'"
_HITS = f"""WITH lexicon AS MATERIALIZED ({_LEXICON}),
    words AS (SELECT doc_id, unnest({_SPLIT}) AS term FROM documents)
    SELECT doc_id, coalesce(n, 0) AS hits FROM documents
    LEFT JOIN (SELECT doc_id, count(*) AS n FROM words JOIN lexicon USING (term) GROUP BY doc_id) USING (doc_id)"""


def _lexicon(spark, sf_dir):
    """All words of toxic documents in other languages than English: thousands of terms."""
    toxic = table(spark, sf_dir, "labels", "doc_id", "toxic").where("toxic = 1").select("doc_id")
    docs = documents(spark, sf_dir, "doc_id", "text", "lang").where("lang <> 'en'").join(toxic, "doc_id")
    return docs.select(F.explode(M.tokens(F.col("text"))).alias("term")).distinct()


@query("toxic_hits_large", _HITS)
def toxic_hits_large(spark, sf_dir):
    """Matches of a lexicon of thousands of words."""
    return M.lexicon_hits(documents(spark, sf_dir), _lexicon(spark, sf_dir))


@query("toxic_hits_joined", _HITS)
def toxic_hits_joined(spark, sf_dir):
    """The same with a lexicon that is too large to broadcast."""
    return M.lexicon_hits(documents(spark, sf_dir), _lexicon(spark, sf_dir), broadcast_terms=0)
