"""Ingestion: raw records to clean, identified documents of a fixed schema."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..functions.markup import decode_markup

INGESTED = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("char_count", T.LongType()),
    T.StructField("word_count", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("ingest_time", T.DoubleType()),
])


@dataclass(frozen=True)
class IngestConfig:
    input_path: str | None = None
    min_text_length: int = 100
    normalize_text: bool = True
    filter_code: bool = True
    id_method: str = "xxhash64"


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and projections share without re-evaluating them.

    Spark pushes a filter below a projection by copying the projected expression into
    it. Filters on the output of a one-element generator stay above it, so the values
    are computed once per row, and nothing that reads them runs earlier.
    """
    names = list(dict.fromkeys([*df.columns, *columns]))
    kept = [c for c in df.columns if c not in columns]
    row = F.array(F.struct(*columns))
    return df.withColumns(columns).select(*kept, F.inline(row)).select(*names)


def clean_text(df: DataFrame, column: str = "text") -> DataFrame:
    """The whole cleaning chain on one column; null becomes empty.

    Markup, entities and NFC take one trip to Python, all further steps stay in the JVM.
    """
    decoded = df.withColumn(column, decode_markup(F.coalesce(F.col(column), F.lit(""))))
    return computed_once(decoded, **{column: X.tidy(F.col(column))})


def long_enough(text: Column, minimum: int) -> Column:
    """Not empty and at least ``minimum`` code points; null fails."""
    return F.length(text) >= max(minimum, 1)


def ingest_time() -> Column:
    """Seconds since the epoch, the same for the whole query."""
    return F.unix_micros(F.current_timestamp()) / F.lit(1e6)


def cast_ingested(df: DataFrame) -> DataFrame:
    """Select and cast to the fixed schema; extra columns are discarded."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in INGESTED])


def ingest(raw: DataFrame, cfg: IngestConfig = IngestConfig(), source: Column | None = None) -> DataFrame:
    """Clean, drop short and code-like texts, add id, counts and source.

    ``source`` defaults to the base name of ``cfg.input_path``. Without a ``text``
    column the result is empty.
    """
    if "text" not in raw.columns:
        return raw.sparkSession.createDataFrame([], INGESTED)
    if source is None:
        name = (cfg.input_path or "unknown").rstrip("/").split("/")[-1]
        source = F.lit(name)
    url = F.col("url") if "url" in raw.columns else F.lit(None)
    docs = raw.select("text", url.cast("string").alias("url"), source.alias("source"))
    if cfg.normalize_text:
        docs = clean_text(docs)
    docs = docs.where(long_enough(F.col("text"), cfg.min_text_length))
    if cfg.filter_code:
        docs = docs.where(~X.is_code(F.col("text")))
    return cast_ingested(docs.select(
        X.doc_id(F.col("text"), cfg.id_method).alias("doc_id"), "text", "url",
        X.char_count(F.col("text")).alias("char_count"),
        X.word_count(F.col("text")).alias("word_count"),
        "source", ingest_time().alias("ingest_time"),
    ))
