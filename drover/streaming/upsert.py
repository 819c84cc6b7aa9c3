"""Keyed state that micro-batches are merged into, one whole table per vintage.

A vintage lies bucketed and sorted by the key. A batch is reduced to a row per key, dealt to the
same buckets, and merged by a full outer join in which the state is read where it lies: its
side has neither exchange nor sort. Each task of the join holds one bucket and writes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from drover.operators import quality
from drover.operators.sorted_state import BUCKETS, KEY, keyed, merged, read_sorted, write_sorted
from drover.sources import tables

def _base(spark: SparkSession, root: str, dataset: str, vintage: str) -> str | None:
    """The published vintage before this one; a replayed batch does not start from its own."""
    said = tables.read_optional(spark, f"{root}/_published")
    if said is None:
        return None
    own = F.lit(vintage).cast("date")
    found = said.filter((F.col("dataset") == dataset) & (F.col("vintage") < own)).agg(F.max("vintage")).first()[0]
    return None if found is None else str(found)


def _path(root: str, dataset: str, vintage: str) -> str:
    return f"{root}/{dataset}/vintage={vintage}"


def upsert_vintage(
    batch: DataFrame, root: str, dataset: str, vintage: str, key: tuple[str, ...], report: DataFrame,
    order: tuple[str, ...] = (), buckets: int = BUCKETS,
) -> bool:
    """Publish the last vintage with the batch merged in. A failed gate leaves the last good
    vintage published, and its report is kept."""
    spark = batch.sparkSession
    kept = tables.record_report(report, root, dataset, vintage)
    if not quality.failures(kept).isEmpty():
        return False
    if dataset in tables.FROZEN:
        raise ValueError(f"{dataset} is frozen")
    if "vintage" in key + order:
        raise ValueError("vintage is the name of the published vintage")
    new = keyed(batch.drop("vintage"), key, order)
    base = _base(spark, root, dataset, vintage)
    state = None if base is None else read_sorted(spark, new.schema, _path(root, dataset, base), buckets)
    write_sorted(new if state is None else merged(state, new, order), _path(root, dataset, vintage), buckets, dealt=state is not None)
    written = spark.read.parquet(f"{root}/{dataset}").filter(F.col("vintage") == F.lit(vintage).cast("date"))
    tables.record_manifest(written.drop(KEY), root, dataset, vintage)
    tables.point_latest(spark, root, dataset, vintage)
    return True


def gated_upsert(
    stream: DataFrame, gate: Callable[[DataFrame], DataFrame], root: str, dataset: str, key: tuple[str, ...],
    checkpoint: str, vintage_of: Callable[[int], str], order: tuple[str, ...] = (), buckets: int = BUCKETS,
) -> StreamingQuery:
    """Every good micro-batch becomes a vintage that is the whole table."""

    def land(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            upsert_vintage(batch, root, dataset, vintage_of(batch_id), key, gate(batch), order, buckets)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
