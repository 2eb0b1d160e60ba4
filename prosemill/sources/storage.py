"""Shared scratch space: staged tables that cut lineage and survive lost executors."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting falls back to a temporary folder,
    because no other machine has to read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="prosemill-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the scratch folder; never one that exists. ``release`` deletes it."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_STAGED: dict[str, list[str]] = {}
_TABLES: dict[str, list[str]] = {}
#: whether a query deletes its shuffle files when it ends, or the driver's garbage collection does some time later
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str, **options) -> DataFrame:
    """Write a frame as Parquet to the scratch folder and read it back.

    Later uses read only the columns they need, and a lost executor re-reads files
    instead of recomputing the plan. ``options`` are those of the Parquet writer. The shuffle
    files of the write, which nothing reads again, are deleted when it ends.
    """
    path = scratch_path(df.sparkSession, name)
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """As :func:`stage`, with the rows bucketed by a column, so that a later join on it
    shuffles the other side only. Cheap for a frame that is partitioned by it already."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"{name}_{path.rsplit('-', 1)[1]}"
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(table)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)


def release(spark: SparkSession) -> None:
    """Delete all that this application put into scratch space; frames that read it end with that."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for table in _TABLES.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    for staged in _STAGED.pop(spark.sparkContext.applicationId, []):
        path = jvm.org.apache.hadoop.fs.Path(staged)
        path.getFileSystem(conf).delete(path, True)


def shuffle_partitions(input_bytes: int) -> int:
    """Shuffle partitions for a wide shuffle of so many bytes: 256 MB each up to 20,000
    partitions; beyond, partitions grow to 2 GB before their number rises further.
    """
    def parts(size):
        return -(-input_bytes // size)

    return max(min(parts(256 << 20), 20_000), parts(2 << 30))


def size_shuffles(df: DataFrame) -> int:
    """Raise ``spark.sql.shuffle.partitions`` if it is too low for the size of a scan;
    returns the number of scan partitions.

    The setting is never lowered; adaptive execution merges what turns out small.
    """
    spark, scan = df.sparkSession, df.rdd.getNumPartitions()
    split = spark.conf.get("spark.sql.files.maxPartitionBytes").lower().removesuffix("b")
    units = {"k": 10, "m": 20, "g": 30}
    size = int(split[:-1]) << units[split[-1]] if split[-1] in units else int(split)
    wanted = shuffle_partitions(scan * size)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", wanted)
    return scan


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for heavy per-row work.

    A scan with fewer partitions than the cluster has cores is small and gets
    redistributed; a large scan is returned as it is. No setting changes.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def output_bytes(spark: SparkSession, path: str) -> int:
    """Total length of the files under a path; file contents are not read."""
    from pyspark.sql import functions as F

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
