"""Profile of a raw JSON-lines corpus whose schema is not known.

Input frames have one string column ``value``, one JSON document per row.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import bound, trim_unicode
from ..sources.storage import stage
from .ingest import computed_once
from .joins import int_median

TEXT_FIELD_MIN = 100


def parsed(lines: DataFrame) -> DataFrame:
    """Lines with ``doc``, null where the line is not valid JSON."""
    return lines.withColumn("doc", F.try_parse_json("value"))


def malformed_count(lines: DataFrame) -> DataFrame:
    doc = parsed(lines)
    return doc.agg(F.count("*").alias("lines"), F.count_if(F.col("doc").isNull()).alias("malformed"))


def line_facts(lines: DataFrame) -> DataFrame:
    """Per line its size in ``chars`` and ``bytes``, whether it is ``malformed``, and ``fields``,
    one entry per top-level key (see :func:`fields`): all that the reports below need, from one
    parse and without the values.
    """
    def entry(e):
        return bound(json_type(F.schema_of_variant(e["value"])), lambda kind: bound(
            F.when(kind == "string", e["value"].cast("string")), lambda string: F.struct(
                e["key"].alias("key"), kind.alias("type"), F.length(string).cast("bigint").alias("chars"),
                ((kind == "null") | F.coalesce(F.length(trim_unicode(string)) == 0, F.lit(False))).alias("blank"))))

    doc = computed_once(parsed(lines), doc=F.col("doc"))
    keyed = F.map_entries(F.try_variant_get(F.col("doc"), "$", "map<string,variant>"))
    return doc.select(
        F.length("value").cast("bigint").alias("chars"), F.octet_length("value").cast("bigint").alias("bytes"),
        F.col("doc").isNull().alias("malformed"), F.transform(keyed, entry).alias("fields"))


def fields(facts: DataFrame) -> DataFrame:
    """One row per document and top-level key: ``key, type, chars, blank``.

    ``type`` is string, number, bool, array, object or null; ``chars`` the length of
    a string value, else null; ``blank`` tells a null or whitespace-only value.
    """
    return facts.select(F.inline("fields"))


def json_type(schema: Column) -> Column:
    return (F.when(schema == "STRING", "string").when(schema == "BOOLEAN", "bool")
             .when(schema == "VOID", "null").when(schema.startswith("ARRAY"), "array")
             .when(schema.startswith("OBJECT"), "object").otherwise("number"))


def field_stats(lines: DataFrame) -> DataFrame:
    """Counts per key and type; the reports below are small queries on top of it."""
    return field_counts(line_facts(lines))


def field_counts(facts: DataFrame) -> DataFrame:
    """As :func:`field_stats`, from the facts of lines."""
    long_text = F.when(F.col("chars") > TEXT_FIELD_MIN, F.col("chars"))
    return fields(facts).groupBy("key", "type").agg(
        F.count("*").alias("n"), F.count_if("blank").alias("blank"),
        F.count(long_text).alias("long_n"), F.sum(long_text).alias("long_sum"),
        F.min(long_text).alias("long_min"), F.max(long_text).alias("long_max"))


def line_total(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count("*").alias("lines"))


def json_key_frequency(stats: DataFrame, total: int) -> DataFrame:
    """Documents per key and their share of all lines, most frequent first."""
    return (stats.groupBy("key").agg(F.sum("n").alias("docs"))
            .withColumn("pct", F.round(F.col("docs") * 100.0 / F.lit(max(total, 1)), 4))
            .orderBy(F.desc("docs"), "key"))


def json_key_types(stats: DataFrame) -> DataFrame:
    return stats.select("key", "type", F.col("n").alias("docs")).orderBy("key", F.desc("docs"), "type")


def text_field_candidates(stats: DataFrame) -> DataFrame:
    """String fields with values above 100 characters: lengths of those values."""
    return (stats.where("long_n > 0").groupBy("key").agg(
        F.sum("long_n").alias("docs"),
        F.round(F.sum("long_sum") / F.sum("long_n"), 4).alias("mean_chars"),
        F.min("long_min").alias("min_chars"), F.max("long_max").alias("max_chars"))
        .orderBy(F.desc("mean_chars"), "key"))


def recommend_text_field(stats: DataFrame) -> DataFrame:
    """The candidate with the greatest mean length; null if there is none."""
    best = text_field_candidates(stats)
    return best.agg(F.max_by("key", F.struct("mean_chars", "key")).alias("text_field"))


def empty_text_count(stats: DataFrame, text_field: str) -> DataFrame:
    """Documents whose text field is null or blank after stripping."""
    return stats.where(F.col("key") == text_field).agg(
        F.coalesce(F.sum("blank"), F.lit(0)).alias("empty_docs"))


def metadata_coverage(stats: DataFrame, total: int) -> DataFrame:
    """Share of documents with each well-known metadata key that occurs; if none
    occurs, all keys that are no text field candidates.
    """
    freq = json_key_frequency(stats, total)
    known = freq.where(F.col("key").isin(*P.METADATA_KEYS))
    if known.isEmpty():
        known = freq.join(text_field_candidates(stats).select("key"), "key", "left_anti")
    return known.orderBy("key")


def doc_size_stats(lines: DataFrame) -> DataFrame:
    """Line sizes in characters and bytes: mean, median (exact), min, max."""
    sizes = lines.select(F.length("value").cast("bigint").alias("chars"), F.octet_length("value").cast("bigint").alias("bytes"))
    return size_stats(stage(sizes, "sizes"))


def size_stats(facts: DataFrame) -> DataFrame:
    """One row of both sizes. They are rows of one table until the end, so that one count in two
    levels finds both medians."""
    each = facts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("size"), F.col(c).alias("value")) for c in ("chars", "bytes")))).alias("s")).select("s.*")
    plain = each.groupBy("size").agg(F.round(F.avg("value"), 4).alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"))
    rows = plain.withColumn("median", F.lit(None).cast("double")).unionByName(int_median(each, "size", "value"), allowMissingColumns=True)
    return rows.groupBy().agg(*(
        F.max(F.when(F.col("size") == c, F.col(name))).alias(f"{name}_{c}") for c in ("chars", "bytes") for name in ("mean", "min", "max", "median")))


def size_class(mean_chars: Column) -> Column:
    return (F.when(mean_chars < 10_000, "small").when(mean_chars < 100_000, "medium").otherwise("large"))


#: advice per size class: bytes per scan partition, rows per Arrow batch
BATCH_ADVICE = {
    "small": {"spark.sql.files.maxPartitionBytes": "128m", "spark.sql.execution.arrow.maxRecordsPerBatch": "5000"},
    "medium": {"spark.sql.files.maxPartitionBytes": "128m", "spark.sql.execution.arrow.maxRecordsPerBatch": "500"},
    "large": {"spark.sql.files.maxPartitionBytes": "64m", "spark.sql.execution.arrow.maxRecordsPerBatch": "50"},
}


def batch_advice(mean_chars: float) -> dict:
    name = "small" if mean_chars < 10_000 else "medium" if mean_chars < 100_000 else "large"
    return {"size_class": name, **BATCH_ADVICE[name]}


def sample_docs(df: DataFrame, order_by, columns, n: int = 3, chars: int = 500) -> DataFrame:
    """The first ``n`` rows in an explicit order, texts cut for display."""
    cut = [F.substring(c, 1, chars).alias(c) if df.schema[c].dataType.simpleString() == "string" else F.col(c)
           for c in columns]
    return df.orderBy(*order_by).limit(n).select(*cut)


def profile_corpus(lines: DataFrame) -> DataFrame:
    """The whole profile as one row: text field, number of fields, which metadata keys
    occur, sizes, quality counts. The fields themselves: :func:`json_key_frequency`.
    """
    lines = stage(line_facts(lines), "lines")  # the one parse
    stats = stage(field_counts(lines), "fields")  # one row per key and type
    text_field = recommend_text_field(stats).first()["text_field"]
    known = F.when(F.col("key").isin(*P.METADATA_KEYS), F.col("key"))
    facts = {
        **stats.agg(F.countDistinct("key").alias("fields"),
                    F.array_sort(F.collect_set(known)).alias("metadata_fields")).first().asDict(),
        **lines.agg(F.count("*").alias("lines"), F.count_if("malformed").alias("malformed")).first().asDict(),
        "empty_docs": empty_text_count(stats, text_field).first()[0] if text_field else 0,
    }
    out = size_stats(lines).select(
        F.lit(text_field).cast("string").alias("text_field"),
        F.array(*map(F.lit, facts.pop("metadata_fields"))).cast("array<string>").alias("metadata_fields"),
        *[F.lit(value).cast("bigint").alias(name) for name, value in facts.items()], "*")
    return out.withColumn("size_class", size_class(F.col("mean_chars")))
