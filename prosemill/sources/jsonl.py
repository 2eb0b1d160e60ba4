"""JSON-lines input and output."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_SCHEMA = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("url", T.StringType()),
])
CORRUPT = "_corrupt_record"


def read_jsonl(spark: SparkSession, path, schema=RAW_SCHEMA, with_corrupt: bool = False) -> DataFrame:
    """Lines as rows of a fixed schema; no inference pass. A missing path raises.

    A malformed line becomes a row of nulls, which ingestion drops; ``with_corrupt``
    keeps its raw content in ``_corrupt_record``, so that a run can count such lines.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    reader = spark.read.option("mode", "PERMISSIVE")
    if with_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).json(path)


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Raw lines as ``value``."""
    return spark.read.text(path)


def file_name(path_column=None):
    """Base name of the file a row came from."""
    path = F.col("_metadata.file_path") if path_column is None else path_column
    return F.element_at(F.split(path, "/"), -1)


def read_pair(spark: SparkSession, raw_path, cleaned_path, schema=RAW_SCHEMA) -> DataFrame:
    """Raw and cleaned corpora as one frame with a ``side`` column, so that one
    aggregation compares them. A missing cleaned corpus contributes no rows.
    """
    from pyspark.errors import AnalysisException

    raw = read_jsonl(spark, raw_path, schema)
    try:
        cleaned = read_jsonl(spark, cleaned_path, raw.schema)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        cleaned = spark.createDataFrame([], raw.schema)
    return pair(raw, cleaned)


def pair(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Both sides tagged and stacked; columns that one side lacks are null."""
    return raw.withColumn("side", F.lit("input")).unionByName(
        cleaned.withColumn("side", F.lit("output")), allowMissingColumns=True)


def export_columns(df: DataFrame) -> DataFrame:
    """``doc_id, text`` and, where present, ``url, source``."""
    optional = [c for c in ("url", "source") if c in df.columns]
    return df.select("doc_id", "text", *optional)


def write_jsonl(df: DataFrame, path: str, max_records_per_file: int = 0) -> None:
    """Sharded JSON lines, replacing what was there; UTF-8 as is, nulls written."""
    (df.write.mode("overwrite").option("ignoreNullFields", "false")
       .option("maxRecordsPerFile", max_records_per_file).json(path))


def write_jsonl_single(df: DataFrame, path: str, order_by=()) -> str:
    """One JSON-lines file, in ``order_by`` order, whatever its size. Returns the path.

    Sharded output is written next to ``path`` and appended, in name order and constant
    memory, to a file of a temporary name that takes the place of ``path`` only when it is
    whole. A failure leaves an earlier file as it was. A single file has a single writer;
    sharded output is the one to choose for large exports.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    shards, whole = f"{path}.shards-{mark}", f"{path}.part-{mark}"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    source, part_path, target = hadoop.Path(shards), hadoop.Path(whole), hadoop.Path(path)
    fs = source.getFileSystem(conf)
    try:
        write_jsonl(df.orderBy(*order_by) if order_by else df, shards)
        parts = sorted(
            s.getPath().toString() for s in fs.listStatus(source)
            if s.getPath().getName().endswith(".json"))
        out = fs.create(part_path, True)
        try:
            for part in parts:
                _append(jvm, fs, hadoop.Path(part), out)
        finally:
            out.close()
        overwrite = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        overwrite[0] = hadoop.Options.Rename.OVERWRITE
        context = hadoop.FileContext.getFileContext(fs.makeQualified(target).toUri(), conf)
        context.rename(fs.makeQualified(part_path), fs.makeQualified(target), overwrite)
    finally:
        fs.delete(source, True)
        fs.delete(part_path, False)
    return path


def _append(jvm, fs, part, out) -> None:
    shard = fs.open(part)
    try:
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(shard, out, 1 << 20, False)
    finally:
        shard.close()
