"""Pluggable scorers: native expressions or batch models in Python workers."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class scorer_registry(dict):
    """Scorers by name; a scorer maps a text column to a result column."""

    def __init__(self, **scorers: Callable[[Column], Column]):
        super().__init__(scorers)

    def register(self, name: str, scorer: Callable[[Column], Column]) -> None:
        self[name] = scorer

    def __missing__(self, name):
        raise KeyError(f"no scorer named {name!r}; registered: {sorted(self)}")


def char_batches(texts: list[str], max_chars: int, batch_size: int | None = None) -> list[list[int]]:
    """Places of texts in batches whose size times their longest text is at most ``max_chars``:
    what a model that pads its texts to one length has to hold. A longer text is alone.

    Batches are runs of the texts in the order of their length, so little of them is padding.
    """
    batches, held = [], []
    for i in sorted(range(len(texts)), key=lambda i: (len(texts[i]), i)):
        # the longest comes last
        if held and ((len(held) + 1) * len(texts[i]) > max_chars or len(held) == batch_size):
            batches.append(held)
            held = []
        held.append(i)
    return batches + [held] if held else batches


def batch_scorer(
    load: Callable[[], object],
    predict: Callable[[object, list], list],
    schema: str,
    on_error: tuple | None = None,
    batch_size: int | None = None,
    max_chars: int | None = None,
) -> Callable[[Column], Column]:
    """Scorer around a model: ``load()`` runs once per Python worker and must raise if
    the model is missing; ``predict(model, texts)`` returns one tuple per text.

    A failing batch yields ``on_error`` for its rows if given, else the error is
    raised. ``batch_size`` limits the texts per call (the Arrow batch otherwise), ``max_chars``
    their number times the length of the longest (see :func:`char_batches`); rows keep their
    order. Null texts are empty ones.
    """

    def run(model, texts: list) -> list:
        try:
            rows = list(predict(model, texts))
        except Exception:
            if on_error is None:
                raise
            return [on_error] * len(texts)
        if len(rows) != len(texts):
            raise ValueError(f"{len(rows)} results for {len(texts)} texts")
        return rows

    def places(texts: list) -> list:
        if max_chars:
            return char_batches(texts, max_chars, batch_size)
        step = batch_size or max(len(texts), 1)
        return [list(range(i, min(i + step, len(texts)))) for i in range(0, len(texts), step)]

    names = [part.split()[0].strip(":") for part in schema.split(",")]

    @F.pandas_udf(schema)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            texts = ["" if t is None else t for t in batch]
            rows = [None] * len(texts)
            for own in places(texts):
                for i, row in zip(own, run(model, [texts[i] for i in own])):
                    rows[i] = row
            yield pd.DataFrame(rows, columns=names)

    return score.asNondeterministic()


class LetterModel:
    """A linear model over the letters of a text, as matrices: texts padded to one length, their
    letters counted at once, and the counts times a weight for each letter."""

    LETTERS = "abcdefghijklmnopqrstuvwxyz"

    def __init__(self, weights):
        import numpy as np

        if len(weights) != len(self.LETTERS):
            raise ValueError("a weight for each letter from a to z")
        self.weights = np.asarray(weights, float)

    def __call__(self, texts: list[str]) -> list[tuple[float]]:
        import numpy as np

        padded = np.zeros((len(texts), max(map(len, texts), default=0)), np.uint32)
        for row, text in zip(padded, texts):
            row[:len(text)] = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.where((padded >= 97) & (padded < 123), padded - 97, 26).astype(np.int64) + 27 * np.arange(len(texts))[:, None]
        counts = np.bincount(place.ravel(), minlength=27 * len(texts)).reshape(-1, 27)[:, :26]
        return [(float(v),) for v in counts @ self.weights]
