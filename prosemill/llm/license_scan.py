"""License scan with a positional index of rare words.

Every template is filed under its rarest words, by how many documents hold them. A file looks
up those of its words that are in the index; each place of such a word proposes a start for
the template (its position less that in the template), and words at the same relative
positions support it. A start counts if enough weight agrees and every mandatory phrase stands
whole. All of this is one projection over the text: nothing is shuffled but the counts of
the templates' words.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ingest import computed_once
from .registry import query, table
from .windows import words_of

#: what lies between words once A-Z are lower-cased
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    """Words of a notice; ``must`` is the phrase in it that has to stand whole. A ``base``
    template is found only where all of its words stand consecutively."""

    label: str
    text: str
    must: str
    base: bool = False


def _base(label: str, text: str) -> Template:
    return Template(label, text, text, True)


BASE = (_base("mit", "under the mit license"), _base("apache-2", "apache license version 2"), _base("cc-by-nc", "cc by nc"))
#: fixed values: opening words of common licences and notices
OWN = (
    Template("gpl", "gnu general public license", "gnu general public license"),
    Template("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license", "gnu affero general public license"),
    Template("mpl-2", "mozilla public license v 2 0", "mozilla public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "permission is hereby granted free of charge"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee",
             "permission to use copy modify and or distribute"),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file",
             "licensed under the apache license"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    Template("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software"),
    Template("all-rights-reserved", "all rights reserved", "all rights reserved"),
)


def _index(templates, holders: dict[str, int], documents: int, filed: int):
    """Rows (label, base, words, weights, must positions, token, its position) of the index."""
    rows = []
    for t in templates:
        words, must = t.text.split(), t.must.split()
        weights = [float(np.log((documents + 1) / (holders.get(w, 0) + 1)) + 0.01) for w in words]
        at = next(i for i in range(len(words)) if words[i:i + len(must)] == must)
        rare = sorted(range(len(words)), key=lambda i: (-weights[i], i))
        # all words of a base template are needed, so its rarest finds every place; for others
        # a few more allow for changed words
        for i in rare[:1 if t.base else filed]:
            rows.append((t.label, t.base, words, weights, list(range(at, at + len(must))), words[i], i))
    return rows


def _literal(rows) -> Column:
    def array(values, kind):
        return F.array(*(F.lit(v).cast(kind) for v in values))

    return F.array(*(F.struct(
        F.lit(label).alias("label"), F.lit(base).alias("base"), array(words, "string").alias("words"),
        array(weights, "double").alias("weights"), F.lit(sum(weights)).alias("total"), array(must, "int").alias("must"),
        F.lit(token).alias("token"), F.lit(at).cast("int").alias("at")) for label, base, words, weights, must, token, at in rows))


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = BASE + OWN, id_col: str = "doc_id",
                  text_col: str = "text", least: float = 0.7, filed: int = 3) -> DataFrame:
    """Per input row: id, ``n_words``, ``n_base`` (places of base phrases), ``first_word`` and
    ``last_word`` (their smallest and largest start, else null), ``base_labels``, ``labels``
    (distinct, sorted, comma-joined), ``score`` (best agreement, 1 for a base phrase, 0 for
    nothing) and ``places`` (label, start, score of all that was found).

    A template other than a base one counts where words of at least ``least`` of its weight
    agree by position and its mandatory phrase stands whole; weights are the logarithm of
    inverse document frequency over all rows. Each is filed under its ``filed`` rarest words.

    The counts that the driver sees are one per word of the templates. A null text counts as
    empty; rows are judged one by one, so null and repeated ids stay. Extra columns are
    ignored; an empty table gives an empty one.
    """
    words = F.col("words")
    rows = computed_once(docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")),
                         words=words_of(F.translate("text", UPPER, LOWER), BETWEEN)).drop("text")
    vocabulary = F.array(*(F.lit(w) for w in sorted({w for t in templates for w in t.text.split()})))
    counts = rows.select(F.explode(F.array_append(F.array_intersect(vocabulary, words), F.lit(""))).alias("word")).groupBy(
        "word").agg(F.count("*").alias("n")).collect()
    holders = {r.word: r.n for r in counts}
    index = _index(templates, holders, holders.pop("", 0), filed)
    tokens = F.array(*(F.lit(t) for t in sorted({r[5] for r in index})))

    def agrees(entry, start):
        return lambda i: F.get(words, start + i) == F.get(entry["words"], i)

    def weight(entry, start):
        size = F.size(entry["words"])
        return F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0.0), lambda s, i: s + F.when(
            agrees(entry, start)(i), F.get(entry["weights"], i)).otherwise(0.0)) / entry["total"]

    def found(entry):
        starts = F.transform(F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda p: F.get(words, p) == entry["token"]),
                             lambda p: p - entry["at"])
        whole = F.filter(starts, lambda s: F.forall(entry["must"], agrees(entry, s)))
        places = F.transform(whole, lambda s: F.struct(
            entry["label"].alias("label"), entry["base"].alias("base"), s.alias("start"),
            F.when(entry["base"], 1.0).otherwise(weight(entry, s)).alias("score")))
        return F.filter(places, lambda p: p["score"] >= least)

    held = F.array_intersect(tokens, words)
    place = "array<struct<label:string,base:boolean,start:int,score:double>>"
    places = F.when(F.size("held") > 0, F.array_distinct(F.flatten(F.transform(
        F.filter(_literal(index), lambda e: F.array_contains("held", e["token"])), found)))).otherwise(F.array().cast(place))
    out = computed_once(rows, held=held)
    out = computed_once(out, places=places).select("key", F.size(words).cast("bigint").alias("n_words"), "places")
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"].cast("bigint"))
    labels = lambda of: F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda p: p["label"]))), ",")
    return out.select(
        F.col("key").alias(id_col), "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"),
        F.least(F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)), F.lit(1.0)).alias("score"),
        F.transform("places", lambda p: F.struct(p["label"].alias("label"), p["start"].alias("start"), p["score"].alias("score"))).alias("places"))


@query("op10_license_scan")
def op10_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text")).drop("places")
