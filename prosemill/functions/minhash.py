"""MinHash signatures and LSH bands: shingles and their hashes in the JVM, minima over the
permutations in Arrow UDFs that see hashes only."""

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import bound, shingles

# Hash families: how a shingle becomes an integer h, and how permutation i maps it.
#   sha1: h = first 4 bytes (little-endian) of SHA-1;
#         ((a*h + b) mod 2^64 mod (2^61 - 1)) mod 2^32, a and b drawn by a seeded generator
#   xxhash64: h = the low 32 bits of Spark's xxhash64, native and without strings; permutations as
#         for sha1
#   md5:  h = first 7 hex digits of MD5; (a*h + b) mod (2^31 - 1), a and b from MD5 of
#         "seed:a:i" and "seed:b:i"; every step fits in a signed 64-bit integer, so plain
#         SQL computes the same signatures
FAMILIES = ("sha1", "xxhash64", "md5")
_MERSENNE_61, _MERSENNE_31 = np.uint64((1 << 61) - 1), np.uint64((1 << 31) - 1)


@lru_cache(maxsize=None)
def best_bands(threshold: float, num_perm: int) -> tuple[int, int]:
    """Bands and rows per band with the least expected error at a Jaccard threshold.

    Minimises half the false-positive area below the threshold plus half the
    false-negative area above it, for ``bands * rows <= num_perm``.
    """
    step = 0.001
    below = np.arange(step / 2, threshold, step)
    above = np.arange(threshold + step / 2, 1, step)
    best = None
    for bands in range(1, num_perm + 1):
        for rows in range(1, num_perm // bands + 1):
            false_hit = np.sum(1 - (1 - below**rows) ** bands)
            miss = np.sum((1 - above**rows) ** bands)
            error = (false_hit + miss) * step / 2
            if best is None or error < best[0]:
                best = (error, bands, rows)
    return best[1], best[2]


@lru_cache(maxsize=8)
def coefficients(family: str, num_perm: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    if family in ("sha1", "xxhash64"):
        draw = np.random.RandomState(seed)
        pairs = [
            (draw.randint(1, _MERSENNE_61, dtype=np.uint64), draw.randint(0, _MERSENNE_61, dtype=np.uint64))
            for _ in range(num_perm)
        ]
        a, b = zip(*pairs)
        return np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)
    if family == "md5":
        def seeded(name, i):
            return int(hashlib.md5(f"{seed}:{name}:{i}".encode()).hexdigest()[:7], 16)

        a = [1 + seeded("a", i) for i in range(num_perm)]
        b = [seeded("b", i) for i in range(num_perm)]
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
    raise ValueError(f"unknown hash family {family!r}; use one of {FAMILIES}")


def shingle_hashes(text: F.Column, ngram: int = 5, family: str = "sha1") -> F.Column:
    """Hash h of every distinct shingle of a text column, as array<bigint>."""
    if family == "sha1":
        def base(gram):
            # the first four bytes as one number, then in the other order
            return bound(F.conv(F.substring(F.sha1(gram), 1, 8), 16, 10).cast("bigint"), lambda x: (
                F.shiftleft(x.bitwiseAND(F.lit(0xFF)), 24) + F.shiftleft(x.bitwiseAND(F.lit(0xFF00)), 8)
                + F.shiftright(x, 8).bitwiseAND(F.lit(0xFF00)) + F.shiftright(x, 24)))
    elif family == "xxhash64":
        def base(gram):
            return F.xxhash64(gram).bitwiseAND(F.lit(0xFFFFFFFF))
    elif family == "md5":
        def base(gram):
            return F.conv(F.substring(F.md5(gram), 1, 7), 16, 10).cast("bigint")
    else:
        raise ValueError(f"unknown hash family {family!r}; use one of {FAMILIES}")
    return F.transform(shingles(text, ngram), base)


def signature(base: np.ndarray, family: str, num_perm: int, seed: int, chunk: int = 256) -> np.ndarray:
    """Minimum of every permutation over the hashes, a cache-sized chunk at a time."""
    a, b = (x.astype(np.uint64) for x in coefficients(family, num_perm, seed))
    base = base.astype(np.uint64)
    bits, prime = (np.uint64(31), _MERSENNE_31) if family == "md5" else (np.uint64(61), _MERSENNE_61)
    low = np.full(num_perm, np.iinfo(np.uint64).max)
    room = np.empty((2, min(chunk, len(base)), num_perm), np.uint64)
    for i in range(0, len(base), chunk):
        own = base[i : i + chunk, None]
        x, other = room[:, : len(own)]
        np.multiply(own, a, out=x)
        x += b
        # x mod a Mersenne prime without a division: fold the high bits, subtract at most once
        np.right_shift(x, bits, out=other)
        x &= prime
        x += other
        np.subtract(x, prime, out=other)
        np.minimum(x, other, out=x)
        if family != "md5":
            x &= np.uint64(0xFFFFFFFF)
        np.minimum(low, x.min(axis=0), out=low)
    return low


def _signatures(hashes: pa.Array, num_perm, seed, family):
    values = hashes.values.to_numpy(zero_copy_only=False)
    ends = hashes.offsets.to_numpy()
    for i in range(len(hashes)):
        own = values[ends[i]:ends[i + 1]] if hashes[i].is_valid else ()
        yield signature(own, family, num_perm, seed) if len(own) else None


def minhash(num_perm: int = 128, seed: int = 42, family: str = "sha1"):
    """UDF shingle hashes -> signature, array<bigint>; null without hashes. The hashes have to
    be a column of their own (see :func:`shingle_hashes`)."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def udf(hashes: pa.Array) -> pa.Array:
        sigs = _signatures(hashes, num_perm, seed, family)
        return pa.array([None if s is None else s.tolist() for s in sigs], pa.list_(pa.int64()))

    return udf.asNondeterministic()


def bucket_keys(sig: np.ndarray, bands: int, rows: int) -> list[bytes]:
    """One 128-bit key per band: MD5 of the band number and its values."""
    values = [str(v) for v in sig.tolist()]
    return [
        hashlib.md5(f"{k}:{','.join(values[k * rows : (k + 1) * rows])}".encode()).digest()
        for k in range(bands)
    ]


def lsh_bands(bands: int, rows: int, num_perm: int = 128, seed: int = 42, family: str = "sha1"):
    """UDF shingle hashes -> bucket keys, array<binary>; empty without hashes."""

    @F.arrow_udf(T.ArrayType(T.BinaryType()))
    def udf(hashes: pa.Array) -> pa.Array:
        sigs = _signatures(hashes, num_perm, seed, family)
        keys = [[] if s is None else bucket_keys(s, bands, rows) for s in sigs]
        return pa.array(keys, pa.list_(pa.binary()))

    return udf.asNondeterministic()
