"""Session settings the results depend on, and a place for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a result depends on (time zone), or that keep plans adaptive and sorted tables sorted.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A bucketed table that is sorted, and has one file per bucket, is read as sorted.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


# Intermediate tables of this driver that release() has yet to delete.
_written: list[str] = []


def builder(app: str = "drover") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, which every executor must reach.

    ``spark.checkpoint.dir`` names it. Where that is unset, as in tests, it becomes a
    folder in the warehouse, which is shared by definition. The rule is the same for
    every master.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_drover"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in :func:`shared_dir`, noted so that :func:`release` removes it."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of it.

    Cuts lineage durably (a lost executor re-reads a file), and gives the planner the
    true size of the table, so it broadcasts it only below its own threshold and
    shuffles it otherwise. Used for aggregates that feed more than one consumer.
    The table stays until :func:`release`.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete what :func:`materialize` has written so far.

    Call it once the results built from it have been consumed; a frame that still
    reads an intermediate table fails afterwards.
    """
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
