"""Sinks for tokenized documents."""

import warnings

from pyspark.sql import DataFrame

FORMATS = ("parquet", "jsonl", "json")


def checked_format(name: str) -> str:
    """Unknown formats fall back to Parquet with a warning; ``json`` means JSON lines."""
    if name not in FORMATS:
        warnings.warn(f"unknown export format {name!r}; writing parquet")
        return "parquet"
    return "jsonl" if name == "json" else name


def write_tokens(df: DataFrame, path: str, export_format: str = "parquet") -> None:
    """Sharded output that replaces an existing one; Parquet is snappy-compressed."""
    writer = df.write.mode("overwrite")
    if checked_format(export_format) == "jsonl":
        writer.option("ignoreNullFields", "false").json(path)
    else:
        writer.option("compression", "snappy").parquet(path)
