"""Table scans and managed-table sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestar.session import ensure_checkpoint_dir, shuffles_freed

# A vector is half a kilobyte and comes again with its word: zstd finds it in a page (Parquet)
# or chunk (ORC) of some megabytes, not in the formats' usual 64 KB to 1 MB.
_COMPACT = {
    "parquet": {"compression": "zstd", "parquet.page.size": str(8 << 20)},
    "orc": {"compression": "zstd", "orc.compress.size": str(4 << 20),
            "orc.buffer.size.enforce": "true"},
}


def read_table(spark: SparkSession, source: str, columns: Sequence[str] | None = None,
               where: Column | str | None = None, fmt: str | None = None) -> DataFrame:
    """Scan a catalog table (``db.table``) or a path, project, filter.

    Projection and filter are declared before any action, so Catalyst pushes
    them into the scan (``ReadSchema`` / ``PushedFilters`` in the plan).
    ``fmt`` (``parquet``/``orc``) marks ``source`` as a path.
    """
    df = spark.read.format(fmt).load(source) if fmt else spark.table(source)
    if columns:
        df = df.select(*columns)
    if where is not None:
        df = df.where(where)
    return df


def save_table(df: DataFrame, name: str, fmt: str = "orc", mode: str = "overwrite",
               partition_by: Sequence[str] | None = None, path: str | None = None,
               bucket_by: str | None = None, buckets: int | None = None,
               dealt: bool = False) -> None:
    """Write a managed table (ORC by default; ``fmt="parquet"`` for S9).

    With ``path`` the table is external at that location.  With ``bucket_by`` it is
    stored in ``buckets`` hash buckets of that column, each sorted by it and
    written by one task: tables of equally many buckets join and aggregate on
    the column without a shuffle.  ``dealt`` states that ``df`` comes from
    ``repartition(buckets, bucket_by)`` already (a bucket is several files otherwise).
    What was shuffled for the table is deleted once it is written.
    """
    if bucket_by is not None:
        if not buckets:
            raise ValueError("bucket_by needs a number of buckets")
        if not dealt:
            df = df.repartition(buckets, bucket_by)
    writer = df.write.mode(mode).format(fmt).options(**_COMPACT.get(fmt, {}))
    if bucket_by is not None:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    with shuffles_freed(df.sparkSession):
        writer.saveAsTable(name)


def save_counted(df: DataFrame, name: str, fmt: str = "orc", mode: str = "overwrite",
                 partition_by: Sequence[str] | None = None, path: str | None = None) -> int:
    """:func:`save_table`, returning the rows written.

    They are counted by the write itself (an observed metric), without a job of
    their own.
    """
    seen = Observation()
    save_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), name, fmt, mode, partition_by,
               path)
    return seen.get["rows"]


def replace_partitions(df: DataFrame, path: str, by: str | Sequence[str],
                       fmt: str = "parquet") -> None:
    """Write ``df`` into the table at ``path``, partitioned by ``by``, replacing the
    partitions that it holds and no other, so that a run can be repeated.

    Rows are rebalanced on ``by`` first: a partition is written as few files, and
    one with a large share of the rows by several tasks.
    """
    by = [by] if isinstance(by, str) else list(by)
    with shuffles_freed(df.sparkSession):
        (df.hint("rebalance", *by).write.mode("overwrite").format(fmt)
         .options(**_COMPACT.get(fmt, {})).option("partitionOverwriteMode", "dynamic")
         .partitionBy(*by).save(path))


def read_partitions(spark: SparkSession, path: str, schema: StructType | str,
                    fmt: str = "parquet") -> DataFrame:
    """The table at ``path`` with the given schema, partition columns included (their
    types are not guessed from folder names)."""
    return spark.read.schema(schema).format(fmt).option("basePath", path).load(path)


def on_days(events: DataFrame, days: DataFrame, day_col: str = "logday") -> DataFrame:
    """``events`` of the days listed in ``days``.  On a table partitioned by day only
    those days' files are read, though they are known at run time only."""
    return events.join(days.select(day_col).distinct(), day_col, "left_semi")


def create_table_if_not_exists(spark: SparkSession, name: str, schema: StructType,
                               fmt: str = "parquet") -> None:
    """``CREATE TABLE IF NOT EXISTS name (...) USING fmt``."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt}")


def write_all(df: DataFrame, sinks: Sequence[Callable[[DataFrame], None]],
              level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> None:
    """Compute ``df`` once for several sinks (persist, write each, unpersist).

    ``persist`` (not ``localCheckpoint``): a lost executor's blocks are
    recomputed from lineage.
    """
    if len(sinks) == 1:
        sinks[0](df)
        return
    cached = df.persist(level)
    try:
        for sink in sinks:
            sink(cached)
    finally:
        cached.unpersist()


def spread(df: DataFrame, key: str | None = None, min_partitions: int | None = None) -> DataFrame:
    """Repartition a scan that is narrower than the cluster before CPU-heavy rows.

    A large input already arrives in thousands of splits and is returned as
    is; a small file with one row group would otherwise be processed in one
    task.  With ``key`` the rows are hash-partitioned on it, so later steps
    grouped by that key (and a checkpoint of their input) need no new shuffle.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target, key) if key else df.repartition(target)
    return df


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    A stage boundary like a written table: later jobs read files instead of
    recomputing the lineage, and a lost executor costs a re-read, not a rerun.
    What was shuffled for it is deleted.
    """
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """:func:`materialize` as a Parquet table in a new folder of the checkpoint folder.

    For tables as long as the input, read more than once: later jobs read the
    columns that they need, which a checkpoint's rows do not allow, and repeated
    ids and words are coded once.  The order of rows is not kept.  What was shuffled
    for it is deleted.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.options(**_COMPACT["parquet"]).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
