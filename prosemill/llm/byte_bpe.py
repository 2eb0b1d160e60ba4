"""Byte-level BPE of whole texts with given ranks, and back.

Each match of the split pattern is encoded alone. Its merges follow a segment tree over the
byte positions: a leaf holds the rank of the pair that begins there, an inner node the
leftmost least rank below it. A merge takes the root, joins two live neighbours and updates
three leaves, each in logarithmic time, so a piece of n bytes costs O(n log n) however
long it is.
"""

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import query, table

_NONE = 1 << 62
#: pieces whose ids a worker remembers, and the longest of them
_REMEMBER, _LONGEST = 300_000, 48
#: matches that are encoded at a time, bytes of results in a batch
_BLOCK, _BATCH = 100_000, 8 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank of each byte string of a file with one base64 string and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: always merge the leftmost pair of the least rank."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    width = 1 << (n - 1).bit_length()
    shift = width.bit_length() - 1
    mask = width - 1
    end = list(range(1, n + 1)) + [n]  # of the token that begins at a position
    before = list(range(-1, n))
    get = ranks.get
    tree = [_NONE] * (2 * width)
    for i in range(n - 1):
        rank = get(piece[i:i + 2])
        if rank is not None:
            tree[width + i] = rank << shift | i
    for node in range(width - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b

    def put(i, value):
        node = width + i
        tree[node] = value
        while node > 1:
            other = tree[node ^ 1]
            node >>= 1
            if other < value:
                value = other
            if tree[node] == value:
                return
            tree[node] = value

    while (least := tree[1]) < _NONE:
        i = least & mask
        j = end[i]  # the right token goes into the left one
        k = end[i] = end[j]
        if k < n:
            before[k] = i
        put(j, _NONE)
        rank = get(piece[i:end[k]]) if k < n else None
        put(i, _NONE if rank is None else rank << shift | i)
        if (h := before[i]) >= 0:
            rank = get(piece[h:k])
            put(h, _NONE if rank is None else rank << shift | h)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:end[i]]])
        i = end[i]
    return ids


class Codec:
    """Encoder and decoder of one worker; remembers the ids of short pieces."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.find = regex.compile(pattern)

        class Pieces(dict):
            def __missing__(own, piece):
                ids = np.array(merge(piece.encode(), self.ranks), "<u4").tobytes()
                if len(piece) <= _LONGEST:
                    if len(own) >= _REMEMBER:
                        own.clear()
                    own[piece] = ids
                return ids

        self.pieces = Pieces()

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        of = self.pieces.__getitem__
        if len(text) < 1 << 20:
            return b"".join(map(of, self.find.findall(text)))
        out, block = [], []
        for match in self.find.finditer(text):
            block.append(match[0])
            if len(block) == _BLOCK:
                out.append(b"".join(map(of, block)))
                block = []
        return b"".join([*out, *map(of, block)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _transcoder(path: str, pattern: str):
    types = (pa.binary(), pa.binary())

    def batch_of(keys, done):
        ids, texts = (pa.array(x, t) for x, t in zip(zip(*done, strict=True), types, strict=True))
        return pa.RecordBatch.from_arrays([keys, ids, texts], names=["key", "ids", "decoded"])

    def run(batches: Iterator[pa.RecordBatch]):
        codec = Codec(path, pattern)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            done, size, first = [], 0, 0
            for i in range(len(texts)):
                ids = codec.encode(texts[i].as_py() or "")
                done.append((ids, codec.decode(ids)))
                size += len(ids) + len(done[-1][1])
                if size > _BATCH:
                    yield batch_of(keys[first:i + 1], done)
                    done, size, first = [], 0, i + 1
            if done:
                yield batch_of(keys[first:], done)

    return run


def transcode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``ids`` (binary: little-endian unsigned 32-bit token ids of the whole text) and
    ``decoded`` (binary: the bytes these ids stand for) of every row.

    ``ranks_path`` is a file on every executor. No special tokens: their strings are ordinary
    text. A null text counts as empty and has no ids. Rows with a null or repeated id are
    coded like any other; all other columns are left out. An empty table gives an empty one.
    The rows need no shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(_transcoder(ranks_path, pattern), f"key {kind}, ids binary, decoded binary")
    return out.withColumnRenamed("key", id_col)


def byte_ranks() -> tuple[str, str]:
    """Path of the ranks and the split pattern of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def digests(coded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return coded.select(
        id_col, (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op7_byte_bpe")
def op7_byte_bpe(spark, sf_dir):
    return digests(transcode(table(spark, sf_dir, "documents", "doc_id", "text"), *byte_ranks()))
