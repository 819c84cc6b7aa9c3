"""Structured Streaming jobs: gated ingestion, bounded revisions."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, MapType, StructType

from drover.operators import quality
from drover.operators.vintage import latest_vintage_wins
from drover.session import materialize
from drover.sources import tables


def file_stream(spark: SparkSession, path: str, schema, pattern: str = "*.parquet", per_batch: int = 1000) -> DataFrame:
    """New files under ``path`` as a stream."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", per_batch)
        .parquet(path)
    )


def gated_append(
    stream: DataFrame, gate: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> StreamingQuery:
    """Run the gate on each micro-batch; good batches land in ``out/accepted``, failed ones
    in ``out/rejected``. Batches are keyed by their id and overwritten, so a batch that is
    replayed after a failure does not duplicate rows."""

    def land(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            ok = quality.failures(gate(batch)).isEmpty()
            batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("batch").parquet(f"{out}/{'accepted' if ok else 'rejected'}")
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def gated_publish(
    stream: DataFrame, gate: Callable[[DataFrame], DataFrame], root: str, dataset: str, checkpoint: str,
    vintage_of: Callable[[int], str],
) -> StreamingQuery:
    """Every micro-batch becomes a vintage: gate, vintage, manifest row and pointer. A batch
    that fails its gate leaves the last good vintage published; its report is kept. A batch
    that is replayed replaces its own vintage."""

    def land(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            tables.publish(batch, root, dataset, vintage_of(batch_id), gate(batch))
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _cutoff(current: DataFrame, day: str, depth_days: int) -> date | None:
    newest = current.agg(F.max(day)).first()[0]
    return None if newest is None else newest - timedelta(days=depth_days)


MARKS = ("_mark", "_mark_back")
#: Tells nested values apart to the last digit; xxhash64 passes over the nulls inside them.
EXACT = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _marks(kinds: StructType) -> dict[str, Column]:
    """128 bits that stand for a whole row: hashes of its columns in both orders, nulls included."""
    parts = []
    for f in kinds:
        c = F.col(f.name).cast(f.dataType)
        nested = isinstance(f.dataType, (ArrayType, MapType, StructType))
        parts += [F.isnull(c), F.to_json(F.struct(c), EXACT) if nested else c]
    return dict(zip(MARKS, (F.xxhash64(*parts), F.xxhash64(*reversed(parts)))))


def late_rows(current: DataFrame, batch: DataFrame, cutoff: date, day: str, vintage: str = "vintage") -> DataFrame:
    """Rows of the batch older than the cutoff that are not known. Known means equal in every
    column but the vintage, nulls included, so that a republished old row is not late.

    Only the marks of the rows are shuffled, by a job of its own. Where all old rows of the batch
    are known, or none is, that says it all; else the known marks or the late ones, whichever are
    fewer, are written and pick the rows."""
    old = F.coalesce(F.col(day) < F.lit(cutoff), F.lit(False))
    columns = [c for c in current.columns if c != vintage]
    mine = batch.filter(old)
    both = current.filter(old).select(*columns).withColumn("_known", F.lit(True)).unionByName(mine.select(*columns).withColumn("_known", F.lit(False)))
    marks = _marks(both.drop("_known").schema)
    seen = both.select("_known", *[c.alias(m) for m, c in marks.items()]).groupBy(*MARKS).agg(
        F.bool_or("_known").alias("_known"), F.bool_and("_known").alias("_absent")
    ).filter(~F.col("_absent")).select(*MARKS, "_known").persist()
    try:
        sizes = {r["_known"]: r["n"] for r in seen.groupBy("_known").agg(F.count(F.lit(1)).alias("n")).collect()}
        n_known, n_late = sizes.get(True, 0), sizes.get(False, 0)
        if not n_known or not n_late:
            return mine if n_late else mine.limit(0)
        fewer_known = n_known < n_late
        chosen = materialize(seen.filter(F.col("_known") == fewer_known).select(*MARKS), "marks")
    finally:
        seen.unpersist()
    return mine.withColumns(marks).join(chosen, list(MARKS), "left_anti" if fewer_known else "left_semi").select(*batch.columns)


def _revised(
    current: DataFrame, batch: DataFrame, cutoff: date | None, key: tuple[str, ...], day: str, vintage: str, ties: tuple[str, ...],
) -> DataFrame:
    if cutoff is None:
        return latest_vintage_wins(batch, key, vintage, ties)
    old = F.coalesce(F.col(day) < F.lit(cutoff), F.lit(False))
    recent = latest_vintage_wins(current.filter(~old).unionByName(batch.filter(~old)), key, vintage, ties)
    return current.filter(old).unionByName(recent)


def bounded_upsert(
    current: DataFrame, batch: DataFrame, key: tuple[str, ...], day: str, depth_days: int,
    vintage: str = "vintage", ties: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """(merged, late). Rows not older than the newest known day minus ``depth_days`` replace
    known rows of the same key; older known rows pass through as they are. Older rows that
    are not known are late: a batch that has some should fail its gate, not lose them."""
    cutoff = _cutoff(current, day, depth_days)
    late = batch.limit(0) if cutoff is None else late_rows(current, batch, cutoff, day, vintage)
    return _revised(current, batch, cutoff, key, day, vintage, ties), late


MONTH = "_month"


def revise(
    stream: DataFrame, state: str, late: str, key: tuple[str, ...], day: str, depth_days: int, checkpoint: str,
    vintage: str = "vintage", ties: tuple[str, ...] = (),
) -> StreamingQuery:
    """:func:`bounded_upsert` as a stream. The state is partitioned by month. A batch reads and
    rewrites the months that may change, and reads of the older ones those that it has rows of;
    late rows land under ``late`` by batch. The first batch is the state, and its empty folder
    under ``late`` says that it is whole: without that it is written again. A replayed
    batch finds its own rows and changes nothing."""

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        month = F.trunc(F.col(day), "month")
        begun = tables.read_optional(spark, late) is not None
        if not begun:
            batch.withColumn(MONTH, month).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(MONTH).parquet(state)
            batch.limit(0).write.mode("overwrite").parquet(f"{late}/batch={batch_id}")
            return
        current = spark.read.parquet(state)
        cutoff = _cutoff(current, day, depth_days)
        first = F.trunc(F.lit(cutoff), "month")
        touched = current.filter(F.col(MONTH).isNull() | (F.col(MONTH) >= first)).drop(MONTH)
        merged = _revised(touched, batch, cutoff, key, day, vintage, ties)
        old_months = [r[0] for r in batch.filter(F.col(day) < F.lit(cutoff)).select(month).distinct().collect()]  # calendar months
        known = current.filter(F.col(MONTH).isin(old_months)).drop(MONTH)
        late_rows(known, batch, cutoff, day, vintage).write.mode("overwrite").parquet(f"{late}/batch={batch_id}")
        # Written aside first: a table cannot be read and overwritten in one job.
        aside = materialize(merged.withColumn(MONTH, month), "revised")
        aside.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(state)

    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
