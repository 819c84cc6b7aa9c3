"""Vintages: unions, latest-wins de-duplication, revisions, content hashes, catalog."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.config import LOT_KEY


def union_sources(sources: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """Union of frames whose columns may differ, each row tagged with its source. Nothing
    is de-duplicated here."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def latest_vintage_wins(
    df: DataFrame, key: tuple[str, ...] = LOT_KEY, vintage: str = "vintage", ties: tuple[str, ...] = ()
) -> DataFrame:
    """One row per key: newest vintage, then the largest tie-break columns, then the
    largest row. Null keys form a group.

    Done as a max-by aggregation, not a ranking window: candidates are reduced before
    the shuffle, so a key shared by a third of the rows still sends one row per task.
    """
    order = [vintage, *ties]
    rest = [c for c in df.columns if c not in order and c not in key]
    row = F.struct(*[c for c in df.columns if c not in key])
    best = df.groupBy(*key).agg(F.max_by(row, F.struct(*order, *rest)).alias("_row"))
    return best.select(*key, "_row.*").select(*df.columns)


def winning_vintage_rows(df: DataFrame, key: tuple[str, ...] = LOT_KEY, vintage: str = "vintage") -> DataFrame:
    """All rows of the newest vintage of each key."""
    newest = df.groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(F.max(vintage).alias("_newest"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    return df.join(newest, same & F.col(vintage).eqNullSafe(F.col("_newest")), "left_semi")


@dataclass(frozen=True)
class Combined:
    """Union of the sources that are present, with provenance."""

    df: DataFrame
    label: str
    present: tuple[str, ...]
    sources: dict[str, DataFrame | None]

    def counts(self, tag: str = "source") -> DataFrame:
        """Rows of every source as it was read, before duplicates are resolved, and whether
        it was there at all."""
        any_df = self.df.sparkSession.range(1)
        lines = []
        for name, df in self.sources.items():
            rows = F.lit(0).cast("long") if df is None else F.count(F.lit(1))
            one = any_df if df is None else df
            lines.append((one.select(rows.alias("rows")) if df is None else one.agg(rows.alias("rows"))).select(
                F.lit(name).alias(tag), "rows", F.lit(df is not None).alias("present")))
        return reduce(DataFrame.unionByName, lines)


def combine(sources: dict[str, DataFrame | None], dedup: bool = True, key: tuple[str, ...] = LOT_KEY) -> Combined | None:
    """Sources that exist, unioned; duplicates are resolved only when there are several.
    None when there is none."""
    found = {name: df for name, df in sources.items() if df is not None}
    if not found:
        return None
    df = union_sources(found)
    if dedup and len(found) > 1:
        df = latest_vintage_wins(df, key)
    names = tuple(found)
    return Combined(df, ("combined: " if len(names) > 1 else "") + " + ".join(names), names, dict(sources))


def revision_counts(new: DataFrame, prior: DataFrame | None, tolerance: float = 1e-6) -> DataFrame:
    """``revision_count`` of each month: 0 if new, prior count if unchanged, else one more."""
    if prior is None:
        return new.withColumn("revision_count", F.lit(0))
    before = prior.select(
        "period", F.col("cpi_u").alias("_was"), F.col("revision_count").cast("int").alias("_count")
    )
    return (
        new.drop("revision_count")
        .join(before, "period", "left")
        .withColumn(
            "revision_count",
            F.when(F.col("_count").isNull(), F.lit(0))
            .when(F.abs(F.col("_was") - F.col("cpi_u")) > tolerance, F.col("_count") + 1)
            .otherwise(F.col("_count")),
        )
        .drop("_was", "_count")
    )


def latest_row(df: DataFrame, by: str) -> DataFrame:
    """The row with the largest ``by``."""
    return df.agg(F.max_by(F.struct(*df.columns), F.struct(by, *df.columns)).alias("_r")).select("_r.*")


def in_publication_order(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Sort for the sink: ascending, missing values last."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in order])


def content_hash(columns: list[str]) -> Column:
    """Order-free fingerprint of a table: independent of file layout and row order."""
    h = F.xxhash64(*[F.col(c) for c in columns])
    return F.sha2(
        F.concat_ws(
            "|",
            F.count(F.lit(1)).cast("string"),
            F.coalesce(F.bit_xor(h), F.lit(0)).cast("string"),
            F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)).cast("string"),
        ),
        256,
    )


def manifest_entry(df: DataFrame, dataset: str, vintage: str, extras: dict[str, Column] | None = None) -> DataFrame:
    """One manifest row: fingerprint, row count, write time and dataset extras."""
    more = [c.alias(n) for n, c in (extras or {}).items()]
    return df.agg(
        F.count(F.lit(1)).alias("rows"), content_hash(sorted(df.columns)).alias("sha256"), *more
    ).select(
        F.lit(dataset).alias("dataset"),
        F.lit(vintage).alias("vintage"),
        F.lit(f"{dataset}/vintage={vintage}").alias("file"),
        "sha256",
        "rows",
        F.current_timestamp().alias("written_at_utc"),
        *list(extras or {}),
    )


def upsert_manifest(manifest: DataFrame, entry: DataFrame) -> DataFrame:
    """Replace the entry of the same dataset and vintage, keep the rest, in vintage order."""
    kept = manifest.join(entry.select("dataset", "vintage"), ["dataset", "vintage"], "left_anti")
    return kept.unionByName(entry, allowMissingColumns=True).orderBy("dataset", "vintage")


def latest_entries(manifest: DataFrame) -> DataFrame:
    """Latest entry and number of vintages per dataset (the freshness table)."""
    rest = [c for c in manifest.columns if c != "dataset"]
    return manifest.groupBy("dataset").agg(
        F.max_by(F.struct(*rest), F.col("vintage")).alias("_r"), F.count(F.lit(1)).alias("n_vintages")
    ).select("dataset", "_r.*", "n_vintages")


def absent_from(wanted: DataFrame, have: DataFrame, name: str) -> DataFrame:
    """Distinct values of ``name`` that are wanted and not there: missing years, new dates."""
    return wanted.select(name).distinct().join(have.select(name).distinct(), name, "left_anti")


def describe(df: DataFrame, dataset: str, day: str) -> DataFrame:
    """Catalog line: rows, columns, first and last date."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.min(day).alias("first_date"), F.max(day).alias("last_date")
    ).select(F.lit(dataset).alias("dataset"), "rows", F.lit(len(df.columns)).alias("n_columns"), "first_date", "last_date")


def catalog(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Catalog of several datasets; each is scanned once for its date column only."""
    return reduce(DataFrame.unionByName, [describe(df, name, day) for name, (df, day) in tables.items()])


def worklist(inventory: DataFrame, present: DataFrame, era: str, name: str = "filename") -> DataFrame:
    """Inventory files of one era that are not there yet."""
    return inventory.filter(F.col("era") == era).join(present.select(name), name, "left_anti")
