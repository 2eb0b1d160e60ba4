"""Hashes of windows over arrays, by doubling, as DataFrame operations."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ingest import computed_once


def words_of(text: Column, separators: str) -> Column:
    """What lies between the separators (a pattern) of a text; linear in its length."""
    return F.array_remove(F.split(text, separators), "")


def _next(first: Column, second: Column, offset: int) -> Column:
    rest = F.slice(second, offset + 1, F.greatest(F.size(second) - offset, F.lit(0)))
    return F.zip_with(first, rest, lambda a, b: F.xxhash64(a, b))


def add_windows(df: DataFrame, items: str, size: int, name: str) -> DataFrame:
    """``df`` with a column of the hashes of ``size`` consecutive elements of an array of
    longs at every place. The last ``size - 1`` places hash what is left of the array, and
    never equal a whole window but by chance. Each doubling is evaluated once per row.
    """
    before, columns, width = df.columns, {1: items}, 1
    while 2 * width <= size:
        columns[2 * width] = f"{name}_{2 * width}"
        df = computed_once(df, **{columns[2 * width]: _next(F.col(columns[width]), F.col(columns[width]), width)})
        width *= 2
    done, last = width, columns[width]
    for part in sorted(columns, reverse=True)[1:]:
        if done + part <= size:
            df = computed_once(df, **{f"{name}_to_{done + part}": _next(F.col(last), F.col(columns[part]), done)})
            done, last = done + part, f"{name}_to_{done + part}"
    return df.select(*before, F.col(last).alias(name))
