"""Weekly windows over a stream, with late rows set aside and counted.

Every micro-batch is split at the watermark of the batches before it. Rows of windows that are still
open become partial totals of the batch, one row per window and key; rows of closed windows,
and rows without a time, land in a table of their own with the reason, and a gate reports
their number. All of it is keyed by the batch id and overwritten, and the watermark of a batch
is read from the records of earlier batches only, so a batch that is replayed after a
failure is split and written as it was the first time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from drover.operators import quality
from drover.sources.tables import read_optional

LATE, UNTIMED = "late", "untimed"


def week_start(ts: Column | str) -> Column:
    """Midnight of the Monday of a timestamp's week."""
    return F.date_trunc("week", ts)


def weekly(rows: DataFrame, keys: tuple[str, ...], ts: str, value: str) -> DataFrame:
    """Monday weeks per key: count, sum, min, max. Rows without a time are in no week."""
    return rows.filter(F.col(ts).isNotNull()).groupBy(week_start(ts).cast("date").alias("week"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high"),
    )


def watermark(spark: SparkSession, out: str, batch_id: int, delay: str) -> Column:
    """Newest time of all earlier batches less the delay; null before there is one."""
    seen = read_optional(spark, f"{out}/progress")
    newest = None if seen is None else seen.filter(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]
    return F.lit(None).cast("timestamp") if newest is None else F.lit(newest) - F.expr(f"INTERVAL {delay}")


def put_aside(ts: str, mark: Column) -> Column:
    """Why a row is in no open window, or null: its week ended at or before the watermark, or it has no time."""
    ended = week_start(ts) + F.expr("INTERVAL 7 DAYS") <= mark
    return F.when(F.col(ts).isNull(), F.lit(UNTIMED)).when(F.coalesce(ended, F.lit(False)), F.lit(LATE))


def _land(df: DataFrame, path: str, batch_id: int) -> None:
    """An empty batch leaves a file, too, so that a reader finds the columns."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def run_windows(
    stream: DataFrame, keys: tuple[str, ...], out: str, checkpoint: str, ts: str = "ts", value: str = "value", delay: str = "14 DAYS",
) -> StreamingQuery:
    """Write partial totals, late rows, gate reports and progress of every batch under ``out``.
    The progress row comes last: without it a batch has not happened for those after it."""

    def land(batch: DataFrame, batch_id: int) -> None:
        timed = batch.withColumn(ts, F.col(ts).cast("timestamp"))
        marked = timed.withColumn("reason", put_aside(ts, watermark(batch.sparkSession, out, batch_id, delay))).persist()
        try:
            _land(marked.filter("reason IS NULL").transform(weekly, keys, ts, value), f"{out}/windows", batch_id)
            _land(marked.filter("reason IS NOT NULL"), f"{out}/late", batch_id)
            rules = [quality.Rule(f"{r}_rows", F.col("reason") == r, sample=F.col(ts)) for r in (LATE, UNTIMED)]
            _land(quality.run_rules(marked, rules), f"{out}/gates", batch_id)
            _land(marked.agg(F.max(ts).alias("newest")), f"{out}/progress", batch_id)
        finally:
            marked.unpersist()

    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_windows(spark: SparkSession, out: str, keys: tuple[str, ...]) -> DataFrame:
    """Current value of every window: the partial totals of all batches together."""
    return spark.read.parquet(f"{out}/windows").groupBy("week", *keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"),
    )


def read_late(spark: SparkSession, out: str) -> DataFrame:
    """Rows that are in no window, with ``reason`` and ``batch``."""
    return spark.read.parquet(f"{out}/late")


def read_gates(spark: SparkSession, out: str) -> DataFrame:
    """The late-row report of every batch, in the shape of all gates."""
    return spark.read.parquet(f"{out}/gates")
