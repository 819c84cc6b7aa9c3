"""Tolerant readers and the sinks: vintages, manifest, publishing, CSV export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from drover.functions.columns import clean_doubles
from drover.operators import quality
from drover.operators.vintage import manifest_entry

# Datasets frozen for a release are never written again.
FROZEN: frozenset[str] = frozenset({"cpi_release", "lots_release"})


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame | None:
    """The table, or None if it does not exist. NaN is read as null."""
    try:
        return clean_doubles(spark.read.format(fmt).options(**options).load(path))
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_any(spark: SparkSession, stem: str, schema: T.StructType | None = None) -> DataFrame | None:
    """``<stem>.parquet`` if present, else ``<stem>.csv``, else None."""
    found = read_optional(spark, f"{stem}.parquet")
    if found is not None:
        return found
    try:
        reader = spark.read.option("header", True)
        reader = reader.schema(schema) if schema is not None else reader
        return clean_doubles(reader.csv(f"{stem}.csv"))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_vintage(df: DataFrame, root: str, dataset: str, vintage: str) -> None:
    """Replace one vintage of a dataset and leave the others alone."""
    if dataset in FROZEN:
        raise ValueError(f"{dataset} is frozen")
    (
        df.drop("vintage")
        .withColumn("vintage", F.lit(vintage).cast("date"))
        .write.partitionBy("vintage")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(f"{root}/{dataset}")
    )


def point_latest(spark: SparkSession, root: str, dataset: str, vintage: str) -> None:
    """Make a vintage the published one. Pointers are appended, so the flip is a single
    small commit and the history of what was published stays readable."""
    spark.range(1).select(
        F.lit(dataset).alias("dataset"),
        F.lit(vintage).cast("date").alias("vintage"),
        F.current_timestamp().alias("published_at"),
    ).write.mode("append").parquet(f"{root}/_published")


def read_latest(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """The published vintage; only its partition is scanned."""
    chosen = (
        spark.read.parquet(f"{root}/_published")
        .filter(F.col("dataset") == dataset)
        .agg(F.max_by("vintage", "published_at"))
        .scalar()
    )
    return spark.read.parquet(f"{root}/{dataset}").filter(F.col("vintage") == chosen)


def record_manifest(df: DataFrame, root: str, dataset: str, vintage: str, extras: dict[str, Column] | None = None) -> None:
    """Write this vintage's manifest row; writing the same vintage again replaces it."""
    entry = manifest_entry(df, dataset, vintage, extras)
    (
        entry.withColumns({"dataset_key": F.col("dataset"), "vintage_key": F.col("vintage")})
        .write.partitionBy("dataset_key", "vintage_key")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(f"{root}/_manifest")
    )


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return (
        spark.read.option("mergeSchema", True).parquet(f"{root}/_manifest")
        .drop("dataset_key", "vintage_key")
        .orderBy("dataset", "vintage")
    )


def record_report(report: DataFrame, root: str, dataset: str, vintage: str) -> DataFrame:
    """Write the gate report of a vintage, replacing an earlier one, and return it as written."""
    path = f"{root}/_gates/dataset={dataset}/vintage={vintage}"
    report.withColumn("checked_at_utc", F.current_timestamp()).write.mode("overwrite").parquet(path)
    return report.sparkSession.read.parquet(path)


def read_reports(spark: SparkSession, root: str) -> DataFrame:
    """Gate reports of every vintage that was tried."""
    return spark.read.parquet(f"{root}/_gates")


def publish(
    df: DataFrame, root: str, dataset: str, vintage: str, report: DataFrame,
    allow_fail: bool = False, extras: dict[str, Column] | None = None,
) -> bool:
    """Write a vintage, and move the published pointer only if no gate failed. Otherwise
    readers keep the last good vintage. The gate report is kept either way."""
    kept = record_report(report, root, dataset, vintage)
    if not allow_fail and not quality.failures(kept).isEmpty():
        return False
    write_vintage(df, root, dataset, vintage)
    spark = df.sparkSession
    written = spark.read.parquet(f"{root}/{dataset}").filter(F.col("vintage") == F.lit(vintage).cast("date"))
    record_manifest(written, root, dataset, vintage, extras)
    point_latest(spark, root, dataset, vintage)
    return True


def export_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV for analysts. ``one_file`` is for tables known to be small."""
    out = df.coalesce(1) if one_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
