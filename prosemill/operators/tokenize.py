"""BPE tokenization."""

import base64
import logging
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ingest import computed_once
from ..sources.tokens import checked_format, write_tokens

log = logging.getLogger("prosemill")

FALLBACK_ENCODING = "gpt2"
#: built-in tokenizer: white-space words, whose ids are the first 28 bits of their MD5
WORDS = "words"
LONG_DOCUMENT = 100_000
#: ids of the documents whose results a worker holds at a time
_BATCH = 500_000
_NO_IDS = np.array([], dtype=np.uint32)
SPECIALS = ("error_empty", "as_text")

# --- fixed values: public definition of the byte-level BPE with 50,257 entries ----
BPE_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_TEXT = "<|endoftext|>"


@dataclass(frozen=True)
class TokenizeConfig:
    enabled: bool = True
    tokenizer_model: str = "gpt2"
    ranks_path: str | None = None  # rank file readable on every executor, instead of a download
    keep_text: bool = False
    parse_special: bool = False  # read special-token strings as special tokens
    special: str = "error_empty"  # otherwise: fail that document, or encode as plain text
    max_length: int | None = None
    export_format: str = "parquet"
    output_path: str | None = None

    def __post_init__(self):
        if self.special not in SPECIALS:
            raise ValueError(f"unknown special policy {self.special!r}; use one of {SPECIALS}")


@lru_cache(maxsize=4)
def encoder(model: str, ranks_path: str | None):
    """The encoder, built once per Python worker; an unknown model becomes gpt2."""
    import tiktoken

    if ranks_path:
        with open(_local_copy(ranks_path), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        return tiktoken.Encoding(
            model, pat_str=BPE_SPLIT, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: len(ranks)})
    try:
        return tiktoken.get_encoding(model)
    except ValueError:
        log.warning("unknown encoding %s, using %s", model, FALLBACK_ENCODING)
        return tiktoken.get_encoding(FALLBACK_ENCODING)


def _local_copy(path: str) -> str:
    """The path itself, or the copy that ``SparkContext.addFile`` shipped to the worker."""
    return path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))


def encode_udf(cfg: TokenizeConfig):
    """UDF text -> struct<ids, error>; a failing document has no ids and the message.

    Results leave the worker after some ``_BATCH`` ids, whatever the size of the batch that came.
    """
    options = {"allowed_special": "all" if cfg.parse_special else set()}
    if cfg.special == "as_text":
        options["disallowed_special"] = ()
    model, ranks_path = cfg.tokenizer_model, cfg.ranks_path

    @F.arrow_udf("ids array<bigint>, error string")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoder(model, ranks_path)

        def results(ids, errors):
            ends = np.cumsum([0, *map(len, ids)])
            flat = np.concatenate([_NO_IDS, *ids]).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            return pa.StructArray.from_arrays([lists, pa.array(errors, pa.string())], ["ids", "error"])

        for texts in batches:
            ids, errors, held = [], [], 0
            for text in texts:
                try:
                    ids.append(enc.encode_to_numpy(text.as_py(), **options))
                    errors.append(None)
                except Exception as err:
                    ids.append(_NO_IDS)
                    errors.append(f"{type(err).__name__}: {err}")
                held += len(ids[-1])
                if held >= _BATCH:
                    yield results(ids, errors)
                    ids, errors, held = [], [], 0
            yield results(ids, errors)

    return encode.asNondeterministic()


def word_ids(text: Column) -> Column:
    """struct<ids, error> like ``encode_udf``, from the words of a text, in the JVM."""
    found = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), "")
    ids = F.transform(found, lambda w: F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("bigint"))
    return F.struct(ids.alias("ids"), F.lit(None).cast("string").alias("error"))


def decode_udf(cfg: TokenizeConfig):
    """UDF ids -> text, for the encodings that ``encode_udf`` knows."""
    model, ranks_path = cfg.tokenizer_model, cfg.ranks_path

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoder(model, ranks_path)
        for ids in batches:
            texts, held = [], 0
            for own in ids:
                # ids of one document at a time become numbers of Python
                texts.append(enc.decode(own.as_py()) if own.is_valid else None)
                held += len(own.values) if own.is_valid else 0
                if held >= _BATCH:
                    yield pa.array(texts, pa.string())
                    texts, held = [], 0
            yield pa.array(texts, pa.string())

    return decode.asNondeterministic()


def truncate(ids: Column, max_length: int | None) -> Column:
    """The first ``max_length`` items; None or 0 keeps all."""
    return F.slice(ids, 1, max_length) if max_length else ids


def tokenize(df: DataFrame, cfg: TokenizeConfig = TokenizeConfig(), metrics=None) -> DataFrame:
    """``doc_id, input_ids, token_count`` plus ``source, url, ingest_time`` where present,
    plus ``text`` if kept. The count is taken after truncation.

    ``metrics`` is an ``Observation``; it receives the numbers of documents that are
    empty, very long (both before truncation) or failed, without a second pass.
    Without ``text`` the result is empty, with the same columns.
    """
    if "text" not in df.columns:
        df = df.limit(0).withColumn("text", F.lit(None).cast("string"))
    encode = word_ids(F.col("text")) if cfg.tokenizer_model == WORDS else encode_udf(cfg)("text")
    encoded = computed_once(df, _tok=encode)
    if metrics is not None:
        encoded = encoded.observe(metrics, *anomaly_counts(F.col("_tok.ids"), F.col("_tok.error")))
    encoded = encoded.withColumn("input_ids", truncate(F.col("_tok.ids"), cfg.max_length))
    extra = [c for c in ("source", "url", "ingest_time") if c in df.columns]
    extra += ["text"] if cfg.keep_text else []
    return encoded.select(
        "doc_id", "input_ids", F.size("input_ids").cast("bigint").alias("token_count"), *extra)


def anomaly_counts(ids: Column, error: Column) -> list[Column]:
    size = F.size(ids)
    return [
        F.count(F.lit(1)).alias("docs"),
        F.count_if((size == 0) & error.isNull()).alias("empty_docs"),
        F.count_if(size > LONG_DOCUMENT).alias("long_docs"),
        F.count_if(error.isNotNull()).alias("failed_docs"),
    ]


def run_tokenization(df: DataFrame, cfg: TokenizeConfig, path: str | None = None, metrics=None):
    """Tokenize and write; the path argument wins over the configuration. Returns the
    path, or None if the step is disabled."""
    if not cfg.enabled:
        return None
    target = path or cfg.output_path
    write_tokens(tokenize(df, cfg, metrics), target, checked_format(cfg.export_format))
    return target
