"""Keyed tables that lie bucketed and sorted, and merges of them without a shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from drover.operators.vintage import latest_vintage_wins

#: Holds the key columns as one text that is never null.
KEY = "state_key"
BUCKETS = 64
#: Rows that a bucket may hold, unless its table is smaller than a few of them.
BUCKET_ROWS = 500_000


def buckets_for(rows: int, least: int = 8) -> int:
    """Buckets of a table of so many rows, so that the task that reads or writes one stays small."""
    return max(least, -(-rows // BUCKET_ROWS))


def keyed(df: DataFrame, key: tuple[str, ...], order: tuple[str, ...] = (), buckets: int | None = None) -> DataFrame:
    """One row per key with :data:`KEY`: the largest ``order``, then the largest row. Null keys are keys.
    With ``buckets`` the rows are dealt once, to those of :func:`write_sorted`: for keys that hardly repeat,
    as nothing is reduced before."""
    if buckets:
        rows = df.withColumns({KEY: F.to_json(F.struct(*key)), "_one": F.lit(0)}).repartition(buckets, KEY)
        first, ties = (order[0], order[1:]) if order else ("_one", ())
        return latest_vintage_wins(rows, (KEY,), first, ties).select(*df.columns, KEY)
    if order:
        one = latest_vintage_wins(df, key, order[0], order[1:])
    else:
        one = latest_vintage_wins(df.withColumn("_one", F.lit(0)), key, "_one").drop("_one")
    return one.withColumn(KEY, F.to_json(F.struct(*key)))


class Buckets:
    """A bucketed table in a folder, under a catalog name of its own that ends with the block.

    The files stay: what makes them buckets is their names, so that any later session can declare
    the table again. Each bucket must be written by one task, as :func:`write_sorted` does; a
    bucket in one piece is read as sorted (``session.SETTINGS``).
    """

    def __init__(self, spark: SparkSession, schema: StructType, path: str, buckets: int):
        self.spark, self.name = spark, f"drover_state_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.ddl = (
            f"CREATE TABLE {self.name} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
            f"INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def __enter__(self) -> str:
        self.spark.sql(self.ddl)
        return self.name

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def write_sorted(rows: DataFrame, path: str, buckets: int = BUCKETS, dealt: bool = False) -> None:
    """Write keyed rows as a bucketed, sorted table. ``dealt`` says that they come from a join on
    :data:`KEY` over as many buckets, or from :func:`keyed` with them, so that each task holds one already."""
    with Buckets(rows.sparkSession, rows.schema, path, buckets) as target:
        (rows if dealt else rows.repartition(buckets, KEY)).write.insertInto(target, overwrite=True)


def read_sorted(spark: SparkSession, schema: StructType, path: str, buckets: int = BUCKETS) -> DataFrame:
    """A table of :func:`write_sorted`, read where it lies."""
    with Buckets(spark, schema, path, buckets) as name:
        return spark.table(name)


def _paired(state: DataFrame, batch: DataFrame, how: str) -> DataFrame:
    columns = [c for c in state.columns if c != KEY]
    new = batch.select(F.struct(*columns).alias("_new"), F.col(KEY).alias("_key"))
    return state.select(F.struct(*columns).alias("_old"), KEY).join(new.hint("merge"), F.col(KEY) == F.col("_key"), how)


def _stays(order: tuple[str, ...]):
    """Whether a known row stays although the batch has one of its key: it is larger by ``order``."""
    rank = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in order])
    return F.coalesce(rank("_old") > rank("_new"), F.lit(False)) if order else F.lit(False)


def merged(state: DataFrame, batch: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """State and batch, one row per key. A row of the batch replaces the state's unless that is
    larger by ``order``. A side that lies bucketed is neither shuffled nor sorted."""
    stays = F.col("_key").isNull() | (F.col(KEY).isNotNull() & _stays(order))
    row = F.when(stays, F.col("_old")).otherwise(F.col("_new"))
    return _paired(state, batch, "full_outer").select(row.alias("_row"), F.coalesce(KEY, "_key").alias(KEY)).select("_row.*", KEY)


def changes(state: DataFrame, batch: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """What the batch does to the state: its rows that hold with ``_sign`` 1, and those they replace
    with -1. The state's other rows are read, key by key, but not passed on."""
    met = _paired(state, batch, "right_outer").filter(F.col(KEY).isNull() | ~_stays(order))
    line = lambda side, sign: F.struct(F.col(side).alias("_row"), F.lit(sign).alias("_sign"))
    gone = F.when(F.col(KEY).isNotNull(), F.array(line("_new", 1), line("_old", -1))).otherwise(F.array(line("_new", 1)))
    return met.select(F.inline(gone)).select("_row.*", "_sign")
