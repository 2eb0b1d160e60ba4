"""Quality and safety filter: language, toxicity, personal data, punctuation."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import language, pii, toxicity
from ..functions import patterns as P
from ..functions import text as X
from .ingest import computed_once
from .joins import hot_keys, join_by_key
from .language_model import load_language_model, predict_language

#: the name of the scorer that reads a trained model
TRAINED = "ngram"


@dataclass(frozen=True)
class FilterConfig:
    enabled: bool = True
    target_language: str = "__label__en"
    min_lang_score: float = 0.65
    sample_chars_for_langid: int | None = None  # the whole text
    language_scorer: str = "stopword"  # "ngram": a trained model below language_model_path
    language_model_path: str | None = None
    max_punc_ratio: float = 0.3
    enable_pii: bool = True
    pii_action: str = "redact"
    enable_toxicity: bool = True
    max_toxic_ratio: float = 0.001
    toxic_words: tuple = P.TOXIC_WORDS

    def __post_init__(self):
        if self.pii_action not in ("redact", "drop"):
            raise ValueError(f"unknown pii_action {self.pii_action!r}; use redact or drop")
        if self.language_scorer == TRAINED and not self.language_model_path:
            raise ValueError("the trained language scorer needs a language_model_path")


def is_language(prediction: Column, target: str, min_score: float) -> Column:
    """Predicted as ``target`` with a score strictly above the minimum."""
    return (prediction["label"] == target) & (prediction["score"] > min_score)


def with_language(df: DataFrame, cfg: FilterConfig) -> DataFrame:
    """Add ``_lang``. ``text`` goes along, so that the costlier text filters that
    follow only see what the language filter lets through.

    A trained model is joined by ``doc_id``; the frame is then read several times, so pass a
    table. Without ids, or with the id null, the language is null.
    """
    text = F.col("text")
    if cfg.language_scorer == TRAINED:
        return _joined_language(df, cfg)
    lang = language.predict(text, cfg.language_scorer, cfg.sample_chars_for_langid)
    return computed_once(df, _lang=lang, text=text)


def _joined_language(df: DataFrame, cfg: FilterConfig) -> DataFrame:
    if "doc_id" not in df.columns:
        return df.withColumn("_lang", F.lit(None).cast("struct<label:string,score:double>"))
    model = load_language_model(df.sparkSession, cfg.language_model_path)
    seen = df.select("doc_id", language.sample(F.col("text"), cfg.sample_chars_for_langid).alias("text"))
    found = predict_language(seen, model).where("doc_id IS NOT NULL").select("doc_id", F.struct("label", "score").alias("_lang"), "rows")
    hot = hot_keys(found, "doc_id", "rows", df.count())
    return join_by_key(df, found.drop("rows"), "doc_id", hot, "left").select(*df.columns, "_lang")


def quality_filter(df: DataFrame, cfg: FilterConfig = FilterConfig()) -> DataFrame:
    """Drop by language, then toxicity, then handle personal data, then drop by
    punctuation of the redacted text. Column order stays. Without ``text`` the frame
    passes unchanged.
    """
    if not cfg.enabled or "text" not in df.columns:
        return df
    text = F.col("text")
    kept = with_language(df, cfg)
    kept = kept.where(is_language(F.col("_lang"), cfg.target_language, cfg.min_lang_score)).drop("_lang")
    if cfg.enable_toxicity:
        kept = kept.where(~toxicity.is_toxic(text, cfg.toxic_words, cfg.max_toxic_ratio))
    if cfg.enable_pii and cfg.pii_action == "drop":
        kept = kept.where(~pii.has_pii(text))
    elif cfg.enable_pii:
        kept = computed_once(kept, text=pii.redact(text))
    return kept.where(X.punc_ratio(text) <= cfg.max_punc_ratio)


def annotate_quality(df: DataFrame, cfg: FilterConfig = FilterConfig()) -> DataFrame:
    """Every score of the filter as a column, nothing dropped; ``text`` stays as read."""
    text = F.col("text")
    scored = with_language(df, cfg)
    redacted = pii.redact(text) if cfg.enable_pii and cfg.pii_action == "redact" else text
    return scored.select(
        *df.columns,
        F.col("_lang.label").alias("lang_label"),
        F.col("_lang.score").alias("lang_score"),
        toxicity.hits(text, cfg.toxic_words).alias("toxic_hits"),
        F.coalesce(toxicity.ratio(text, cfg.toxic_words), F.lit(0.0)).alias("toxic_ratio"),
        pii.has_pii(text).alias("has_pii"),
        X.punc_ratio(redacted).alias("punc_ratio"),
    )
