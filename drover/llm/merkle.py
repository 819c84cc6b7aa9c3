"""Merkle manifest of a dataset as a rollup of nested structs.

Leaves get their rank in their group from one range partitioning. The octal digits of the
rank are then grouped away one at a time, each grouping nesting the child structs of a node,
until a block of ``8 ** BLOCK_DIGITS`` leaves is one row; the block roots go through the same
rollup, and so on to the root. Proofs come down the same way: the path above a block enters
the last grouping of the block as one more row, so no join carries them, and each row is
then exploded level by level.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drover.session import materialize

# Fixed value: consecutive nodes that become one.
FAN = 8
BITS = 3
#: Digits of the rank that are nested into one row: 8 ** 4 leaves of some 200 bytes each.
BLOCK_DIGITS = 4
#: Octal digits that a long count can have.
_DIGITS = 21


def digest(value: Column) -> Column:
    """Lowercase hex sha256 of a string's UTF-8 bytes."""
    return F.sha2(value.cast("binary"), 256)


def leaf(fields: list[Column]) -> Column:
    """Digest of a row: per field ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    said = [f.cast("string") for f in fields]
    return digest(F.concat(*(
        F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)) for s in said
    )))


def depth(size: Column) -> Column:
    """Levels above ``size`` leaves: the least d with 8 ** d >= size."""
    levels = F.lit(0)
    for d in range(_DIGITS):
        levels = levels + (size > F.lit(FAN**d)).cast("int")
    return levels


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank``, the place of the row in its group, and ``size``, the rows of the
    group. One range partitioning; ids that grow within a partition give the place there, and one
    row per (partition, group) the offset, so a group of any size is spread over partitions."""
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = materialize(dealt.withColumn("_at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_at", 33)
    each = Window.partitionBy(group)
    before = each.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part.alias("_part"), group).agg(F.count("*").alias("n"), F.min("_at").alias("_least"))
        .select(
            "_part", F.col(group).alias("_group"), "_least", F.sum("n").over(each).alias("size"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"),
        )
    )
    starts = materialize(starts, "starts")
    found = placed.join(starts, (part == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group")))
    return found.withColumn("rank", F.col("_at") - F.col("_least") + F.col("_before")).drop(
        "_at", "_part", "_group", "_least", "_before"
    )


def _hashed(kids: str, level: int) -> Column:
    """Hash of a node from its children; above the root of a shallow tree the hash is passed on."""
    hashes = F.col(kids).getField("h")
    return F.when(F.col("depth") >= level, digest(F.array_join(hashes, ""))).otherwise(hashes[0])


def _children() -> Column:
    return F.sort_array(F.collect_list(F.struct("digit", "h", "down"))).alias("down")


def paths(
    nodes: DataFrame, keys: list[str], most: int, above: Callable[[DataFrame], DataFrame], digits: int = BLOCK_DIGITS
) -> DataFrame:
    """Path to the top of every node.

    ``nodes`` has ``keys``, ``rank`` and ``depth`` of the tree, ``h`` and a struct ``down``, which
    is handed through. ``most`` is the depth of the deepest tree. ``above`` turns (keys, h) of the
    tops into (keys, path), a path being a struct with at least ``steps``, an array of
    (before, after), the joined siblings on either side, from below to the top.
    """
    mask = FAN**digits - 1
    now = nodes.select(
        *keys, "depth", F.shiftright("rank", BITS * digits).alias("block"), "h", "down",
        F.col("rank").bitwiseAND(F.lit(mask)).alias("slot"),
    ).repartition(*keys, "block")
    digit = F.col("slot").bitwiseAND(F.lit(FAN - 1)).cast("int")
    for level in range(1, digits):
        now = now.withColumn("digit", digit).groupBy(*keys, "block", "depth", F.shiftright("slot", BITS).alias("slot")).agg(_children())
        now = now.withColumn("h", _hashed("down", level))
    tops = materialize(now.select(*keys, "block", "depth", digit.alias("digit"), "h", "down"), "nested")

    heads = tops.groupBy(*keys, "block", "depth").agg(F.sort_array(F.collect_list(F.struct("digit", "h"))).alias("heads"))
    heads = heads.withColumn("h", _hashed("heads", digits)).drop("heads")
    if most <= digits:
        upper = above(heads.select(*keys, "h")).withColumn("block", F.lit(0).cast("long"))
    else:
        next_depth = F.greatest(F.col("depth") - digits, F.lit(0)).alias("depth")
        more = heads.select(*keys, F.col("block").alias("rank"), next_depth, "h", F.struct(F.col("block").alias("number")).alias("down"))
        upper = paths(more, keys, most - digits, above, digits).withColumn("block", F.col("down.number"))
    met = tops.unionByName(upper.select(*keys, "block", "path"), allowMissingColumns=True).groupBy(*keys, "block").agg(
        F.sort_array(F.collect_list(F.when(F.col("digit").isNotNull(), F.struct("digit", "h", "down")))).alias("down"),
        F.max("depth").alias("depth"), F.first("path", ignorenulls=True).alias("path"),
    )
    steps = F.col("path.steps")
    out = met.select(*keys, "depth", "path", steps.alias("steps"), "down")
    for level in range(digits, 0, -1):
        each = out.select(*keys, "depth", "path", "steps", F.col("down.h").alias("hashes"), F.posexplode("down").alias("at", "kid"))
        beside = F.struct(
            F.array_join(F.slice("hashes", F.lit(1), F.col("at")), "").alias("before"),
            F.array_join(F.slice("hashes", F.col("at") + 2, F.lit(FAN)), "").alias("after"),
        )
        taken = F.when(F.col("depth") >= level, F.concat(F.array(beside), "steps")).otherwise(F.col("steps"))
        out = each.select(*keys, "depth", "path", taken.alias("steps"), F.col("kid.h").alias("h"), F.col("kid.down").alias("down"))
    return out.select(*keys, "h", "down", F.col("path").withField("steps", F.col("steps")).alias("path"))


def manifest(
    df: DataFrame, fields: list[str], key: str = "doc_id", group: str = "lang", carry: dict[str, Column] | None = None,
    digits: int = BLOCK_DIGITS,
) -> DataFrame:
    """``key``, the columns of ``carry``, ``leaf``, ``subroot``, ``root`` and ``steps`` of every row.

    A leaf is the digest of ``fields``. In each group leaves ascend by ``key``, null first, ties
    by leaf; equal rows are interchangeable. The subroots, by group as UTF-8 bytes, null
    first, lead to the root. Null values have a leaf of their own (``-``), an empty table no rows.
    Other columns are not read, whatever their names.
    """
    carry = carry or {}
    rows = df.select(
        F.col(group).alias("g"), F.col(key).alias("k"), leaf([F.col(f) for f in fields]).alias("h"),
        F.struct(F.col(key).alias("key"), *(c.alias(f"c{i}") for i, c in enumerate(carry.values()))).alias("down"),
    )
    # The number keeps equal rows apart, so that they spread over range partitions.
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")
    leaves = ranked(rows, "g", ["k", "h", "row"])
    most = lambda d: (d.agg(F.max(depth(F.col("size")))).first()[0]) or 0
    steps = "array<struct<before: string, after: string>>"

    def summit(top: DataFrame) -> DataFrame:
        return top.select(F.struct(F.col("h").alias("root"), F.array().cast(steps).alias("steps")).alias("path"))

    def over_groups(subroots: DataFrame) -> DataFrame:
        named = subroots.select(F.lit(0).alias("all"), F.col("g").alias("k"), "h", F.struct("g").alias("down"))
        nodes = ranked(named, "all", ["k"])
        found = paths(nodes.withColumn("depth", depth(F.col("size"))), [], most(nodes), summit, digits)
        return found.select(
            F.col("down.g").alias("g"),
            F.struct(F.col("h").alias("subroot"), F.col("path.root").alias("root"), F.col("path.steps").alias("steps")).alias("path"),
        )

    found = paths(leaves.withColumn("depth", depth(F.col("size"))), ["g"], most(leaves), over_groups, digits)
    return found.select(
        F.col("down.key").alias(key), *(F.col(f"down.c{i}").alias(n) for i, n in enumerate(carry)),
        F.col("h").alias("leaf"), "path.subroot", "path.root", "path.steps",
    )


def proof(steps: Column) -> Column:
    """All siblings of a path, level by level, left to right, as one string of digests."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), "")


def folded(start: Column, steps: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(steps, start, lambda h, s: digest(F.concat(s["before"], h, s["after"])))
