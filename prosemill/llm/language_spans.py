"""Language identification of mixed texts: script ranges, word scores, Viterbi.

A text is cut into words, runs of letters of one script. The scripts in which a language is
written narrow a word's candidates; each candidate scores the word by its character n-grams.
Viterbi then labels the words of the whole text, at a penalty for each switch of language, and
words of one label in a row are a span. Counts for the model cover all rows it learns from.
"""

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import query, table
from .shingles import mix

#: lengths of the character n-grams of a word with a blank at each end, and slots for their hashes
GRAMS, SLOTS = (3, 4), 1 << 16
#: what a switch of language costs, in nats; the least share of a language's letters in a script
PENALTY, LEAST_SHARE = 20.0, 0.01
#: languages that a model has at most: they are rows of a table that every task holds
MOST_LANGUAGES = 500
UNKNOWN = "und"
#: code points of texts that are scored at once; a longer text is taken alone
_BLOCK = 1 << 20
_INHERITED, _NEVER = 255, -1e9


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """(script number, lower case) of each code point. The script is the first word of a
    letter's or mark's name; 0 is no letter, combining marks take that of the letter before."""
    script, lower = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint32)
    numbers: dict[str, int] = {}
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LM" and (name := unicodedata.name(chr(c), "").split(" ")[0]):
            if name == "COMBINING":
                script[c] = _INHERITED
            elif kind == "L" or name in numbers:
                script[c] = numbers.setdefault(name, len(numbers) % 253 + 1)
                if len(chr(c).lower()) == 1:
                    lower[c] = ord(chr(c).lower())
    return script, lower


def slot(chars: list[np.ndarray]) -> np.ndarray:
    """The slots of n-grams, given as one array per place."""
    h = np.zeros(len(chars[0]), np.uint64)
    for row in chars:
        h = h * np.uint64(0x9E3779B97F4A7C15) + row.astype(np.uint64)
    return (mix(h) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


@dataclass
class Words:
    """The words of some texts: text number, first and last code point (from 0, exclusive) in
    it, script; ``grams`` holds for each length the slots of all n-grams and their words."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    grams: list[tuple[np.ndarray, np.ndarray]]


def cut_words(texts: list[str]) -> Words:
    script_of, lower_of = _characters()
    raw = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    script = script_of[raw]
    if (script == _INHERITED).any():
        script = script[np.maximum.accumulate(np.where(script != _INHERITED, np.arange(len(raw)), 0))]
    change = np.flatnonzero(script[1:] != script[:-1]) + 1
    start = change[script[change] > 0]
    end = change[script[change - 1] > 0]
    bounds = np.cumsum([1, *(len(t) + 1 for t in texts)])
    doc = np.searchsorted(bounds, start, "right") - 1
    # a word's n-grams end at each of its letters and at the blank after it
    plain = np.where(script > 0, lower_of[raw], 32)
    size = end - start + 1
    first = np.concatenate([[0], np.cumsum(size)])
    off = np.arange(first[-1]) - np.repeat(first[:-1], size)
    at, word = np.repeat(start, size) + off, np.repeat(np.arange(len(start)), size)
    last = at == np.repeat(end, size)
    grams = []
    for n in GRAMS:
        ok = np.flatnonzero(off >= n - 2)
        here = at[ok]
        chars = [plain[here - k] for k in range(n - 1, -1, -1)]
        # next to a word of another script there is no blank
        chars[-1][last[ok]] = 32
        chars[0][off[ok] == n - 2] = 32
        grams.append((slot(chars), word[ok]))
    return Words(doc, start - bounds[doc], end - bounds[doc], script[start], grams)


def _blocks(column: pa.Array):
    block, size = [], 0
    for text in column.to_pylist():
        text = text or ""
        if block and size + len(text) > _BLOCK:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


# -------------------------------------------------------------------------------- learning


@dataclass(frozen=True)
class LanguageModel:
    """``loss[l]``: log share of each n-gram slot in language l, relative to that in all of
    them; ``written[s, l]``: whether l is a candidate for words of script s."""

    names: tuple[str, ...]
    loss: np.ndarray
    written: np.ndarray


def _counts(batches):
    """Per language counts of the slots, then of letters by script, of a task's rows."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        names = batch["lang"].to_pylist()
        row = 0
        for block in _blocks(batch["text"]):
            words = cut_words(block)
            own = names[row:row + len(block)]
            row += len(block)
            for name in set(own):
                mine = np.array([x == name for x in own])[words.doc]
                count = total.setdefault(name, np.zeros(SLOTS + 256, np.int64))
                for slots, word in words.grams:
                    count[:SLOTS] += np.bincount(slots[mine[word]], minlength=SLOTS)
                count[SLOTS:] += np.bincount(words.script[mine], (words.end - words.start)[mine], 256).astype(np.int64)
    for name, count in total.items():
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(count[at])],
                                         names=["lang", "slot", "n"])


def model_of(names: tuple[str, ...], counts: np.ndarray, smooth: float = 0.05) -> LanguageModel:
    """From counts (language, slot, then script). A slot's share is mixed with that in all
    languages, in equal measure whatever a language's size, so unseen ones favour none."""
    grams, letters = counts[:, :SLOTS].astype(float), counts[:, SLOTS:].astype(float)
    total = np.maximum(1, grams.sum(1, keepdims=True))
    every = ((grams / total).sum(0) + 1 / SLOTS) / (len(names) + 1)
    loss = np.log((grams / total + smooth * every) / (1 + smooth)) - np.log(every)
    share = letters / np.maximum(1, letters.sum(1, keepdims=True))
    written = (share >= LEAST_SHARE).T
    written |= ~written.any(1, keepdims=True)
    return LanguageModel(names, loss.astype(np.float32), written)


def learn_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel | None:
    """A model of the languages in ``lang_col``; None if there is nothing to learn from.

    All rows with text and language count whose ``crc32(id as text) % 5`` is not 0; rows with a
    null id do not. The driver gets one count per language and slot. More than MOST_LANGUAGES
    values of ``lang_col`` are an error: they are no languages.
    """
    rows = docs.where((F.crc32(F.col(id_col).cast("string")) % 5 != 0) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    names = tuple(sorted(r.lang for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()))
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in {lang_col}")
    if not names:
        return None
    found = rows.mapInArrow(_counts, "lang string, slot int, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(names), SLOTS + 256), np.int64)
    counts[np.searchsorted(names, found["lang"].to_numpy(str)) if len(found) else [], found["slot"].to_numpy(int)] = found["n"].to_numpy(int)
    return model_of(names, counts)


# --------------------------------------------------------------------------------- scoring


def word_scores(words: Words, model: LanguageModel) -> np.ndarray:
    """(word, language) sums over n-grams; far below all for languages not in the script."""
    out = np.zeros((len(words.doc), len(model.names)))
    for slots, word in words.grams:
        for k in range(len(model.names)):
            out[:, k] += np.bincount(word, model.loss[k][slots], len(words.doc))
    # n-grams of two lengths say nearly the same
    return np.where(model.written[words.script], out / len(GRAMS), _NEVER)


def _firsts(doc: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.empty(0, np.int64)


def settled(scores: np.ndarray, first: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """(best single language, whether it is the best labelling) of each text.

    It is if no run of words gains half a penalty under any other language: a labelling with
    runs of other languages switches at least once for every two of them.
    """
    size = np.diff([*first, len(scores)])
    top = np.add.reduceat(scores, first).argmax(1)
    text = np.repeat(np.arange(len(first)), size)
    own, sure = scores[np.arange(len(scores)), top[text]], np.ones(len(first), bool)
    for k in range(scores.shape[1]):
        # cutting off large losses can only make gains larger
        upto = np.cumsum(np.clip(scores[:, k] - own, -1e4, 1e4))
        before = np.concatenate([[0.0], upto[:-1]])
        # the smallest sum before a word of its text: those of earlier texts are lifted above it
        lift = text * (np.ptp(before) + 1)
        least = np.minimum.accumulate(before - lift) + lift
        sure &= np.maximum.reduceat(upto - least, first) < penalty / 2 - 1e-3
    return top, sure


def viterbi(scores: np.ndarray, doc: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best language of each word, for the words of many texts in order.

    Per text the labels maximise the sum of scores less the penalty of each switch; ties go to
    the earlier language, and to staying. Texts in doubt advance together, a word at a time.
    """
    first = _firsts(doc)
    if not len(first):
        return np.zeros(0, np.int64)
    size = np.diff([*first, len(doc)])
    top, sure = settled(scores, first, penalty)
    label = np.repeat(top, size)
    first, size = first[~sure], size[~sure]
    if not len(first):
        return label
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    alive = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")  # texts with that many words
    value = scores[first]
    stays, best = np.ones(scores.shape, bool), np.zeros(len(doc), np.int64)
    for t in range(1, size[0]):
        n = alive[t]
        at, now = first[:n] + t, value[:n]
        best[at] = now.argmax(1)
        switch = now.max(1, keepdims=True) - penalty
        stays[at] = now >= switch
        value[:n] = np.maximum(now, switch) + scores[at]
    state = value.argmax(1)
    for t in range(size[0] - 1, -1, -1):
        n = alive[t]
        at = first[:n] + t
        label[at] = state[:n]
        state[:n] = np.where(stays[at, state[:n]], state[:n], best[at])
    return label


def _label(texts: list[str], model: LanguageModel, penalty: float):
    """(language, score, spans) of each text."""
    words = cut_words(texts)
    scores = word_scores(words, model)
    label = viterbi(scores, words.doc, penalty)
    k, letters = len(model.names), words.end - words.start
    held = np.bincount(words.doc * k + label, letters, len(texts) * k).reshape(-1, k).astype(float)
    total, top = held.sum(1), held.argmax(1)
    # how far the words labelled with the top language prefer it to the next best
    mine = label == top[words.doc]
    sums = np.stack([np.bincount(words.doc[mine], scores[mine, j], len(texts)) for j in range(k)], 1).astype(float)
    lead = sums[np.arange(len(texts)), top]
    sums[np.arange(len(texts)), top] = -np.inf
    sure = 1 / (1 + np.exp(-np.clip(lead - sums.max(1), -50, 50)))
    score = held.max(1) / np.maximum(1, total) * sure
    new = np.ones(len(label), bool)
    new[1:] = (label[1:] != label[:-1]) | (words.doc[1:] != words.doc[:-1])
    at = np.flatnonzero(new)
    until = np.concatenate([at[1:], [len(label)]])[:len(at)] - 1
    spans = [[] for _ in texts]
    for i, j in zip(at, until):
        spans[words.doc[i]].append({"start": int(words.start[i]), "end": int(words.end[j]), "lang": model.names[label[i]]})
    return [(model.names[top[i]], float(score[i]), spans[i]) if total[i] else (UNKNOWN, 0.0, []) for i in range(len(texts))]


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))


def _labelling(model, penalty: float):
    def run(batches):
        for batch in batches:
            rows = [row for block in _blocks(batch["text"]) for row in (
                _label(block, model.value, penalty) if model.value else [(UNKNOWN, 0.0, [])] * len(block))]
            if rows:
                lang, score, spans = zip(*rows)
                yield pa.RecordBatch.from_arrays([batch["id"], pa.array(lang), pa.array(score), pa.array(spans, _SPANS)],
                                                 names=["id", "lang_pred", "score", "spans"])

    return run


def identify_languages(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text",
                       penalty: float = PENALTY) -> DataFrame:
    """Per input row: id, ``held_out`` (``crc32(id as text) % 5`` is 0), ``lang_pred``, ``score``
    (0 to 1) and ``spans`` (start, end in code points, lang) of the whole text.

    ``lang_pred`` is the language with most letters in spans, ties to the first by name; its
    share of the letters, times how sure its words are of it, is the score. A text that is null
    or has no letter is ``und`` with score 0 and no spans, and so is every text without a model.
    Words of scripts that no language was seen in may be of any. The prediction reads the text
    alone, so repeated rows and null ids are rows like any other (a null id is not held out).
    Extra columns are ignored; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = rows.mapInArrow(_labelling(shared, penalty), "id bigint, lang_pred string, score double, "
                          "spans array<struct<start:int,end:int,lang:string>>")
    held = F.coalesce(F.crc32(F.col("id").cast("string")) % 5 == 0, F.lit(False))
    return out.select(F.col("id").alias(id_col), held.alias("held_out"), "lang_pred", "score", "spans")


@query("op11_language_spans")
def op11_language_spans(spark, sf_dir):
    model = learn_languages(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return identify_languages(table(spark, sf_dir, "documents", "doc_id", "text"), model).drop("spans")
