import pytest
from pyspark.sql import functions as F

from prosemill.llm.windows import add_windows, words_of


@pytest.mark.parametrize("size", [1, 2, 3, 5, 7, 8])
def test_windows_are_equal_where_their_elements_are(spark, size):
    rows = [(0, [1, 2, 3, 1, 2, 3, 1, 2, 3, 4, 5]), (1, list(range(20))), (2, []), (3, [7]), (4, [1, 2, 3, 1, 2, 3, 1, 2])]
    df = spark.createDataFrame(rows, "i int, w_items array<bigint>")
    got = {r.i: (r.w_items, r.w) for r in add_windows(df, "w_items", size, "w").collect()}
    by_hash, by_value = {}, {}
    for i, (items, windows) in got.items():
        assert len(windows) == len(items) == len(dict(rows)[i])
        for k in range(len(items) - size + 1):
            by_hash.setdefault(windows[k], set()).add((i, k))
            by_value.setdefault(tuple(items[k:k + size]), set()).add((i, k))
    assert sorted(map(sorted, by_hash.values())) == sorted(map(sorted, by_value.values()))
    whole = {h for h in by_hash}
    rest = {h for items, windows in got.values() for h in windows[max(0, len(items) - size + 1):]}
    assert size == 1 or not whole & rest


def test_words(apply):
    assert apply(lambda c: words_of(c, "[ ,]+"), ["", " a, b", "a", ", ", None]) == [[], ["a", "b"], ["a"], [], None]
    assert apply(lambda c: F.size(words_of(c, " ")), ["x " * 300_000]) == [300_000]
