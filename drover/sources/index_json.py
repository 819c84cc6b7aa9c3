"""Price-index JSON: one body, or a list of bodies where later ones win."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drover.operators.quality import monthly

POINT = "struct<year:string,period:string,value:string>"
BODY = f"struct<Results:struct<series:array<struct<data:array<{POINT}>>>>>"


def raw_points(payloads: DataFrame, body: str = "value") -> DataFrame:
    """(year, period, value) text rows; per month the last one of the payload wins."""
    text = F.col(body)
    bodies = F.when(F.ltrim(text).startswith("["), F.from_json(text, f"array<{BODY}>")).otherwise(
        F.array(F.from_json(text, BODY))
    )
    points = payloads.select(F.posexplode(bodies).alias("_body", "b")).select(
        "_body", F.posexplode(F.col("b.Results.series")[0]["data"]).alias("_row", "p")
    )
    return points.groupBy("p.year", "p.period").agg(
        F.max_by("p.value", F.struct("_body", "_row")).alias("value")
    )


def index_table(points: DataFrame, vintage: Column | str) -> DataFrame:
    """Monthly index; aggregates over months and non-numeric values are dropped."""
    return monthly(points).filter(F.col("cpi_u").isNotNull()).select(
        "period", "cpi_u", F.lit(vintage).cast("date").alias("vintage"), F.lit(0).alias("revision_count")
    )


def read_latest_points(spark: SparkSession, path: str) -> DataFrame:
    """Points of the newest file (by name) under ``path``."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("_file"))
    names = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("_file"))
    return raw_points(files.filter(F.col("_file") == names.agg(F.max("_file")).scalar()))
