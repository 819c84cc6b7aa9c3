"""Resharding by minimum-cost flow: old shard sizes and new capacities decide which blocks move.

A block is the set of rows of one old shard that share a hash of their key. Block sizes
are summed on the cluster; the driver sees at most ``old shards x blocks`` numbers,
solves the flow between shards and fills it with blocks. Rows then look up their block,
and the shards that change are written anew.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drover.session import fresh_path

#: Blocks per old shard. The bound on what the driver holds is this times the old shards.
BLOCKS = 2048
#: Parts of a new shard that tasks take and write on their own.
PARTS = 64


def min_cost_flow(
    supply: Sequence[int], demand: Sequence[int], cost: Callable[[int, int], int]
) -> dict[tuple[int, int], int]:
    """Bytes to send from each source to each target at the lowest total cost.

    Successive shortest paths over the bipartite graph, with potentials so that every
    search is a Dijkstra on non-negative reduced costs. The sums of ``supply`` and
    ``demand`` must agree. Costs must be non-negative integers.
    """
    if sum(supply) != sum(demand):
        raise ValueError("supply and demand must have the same sum")
    n, m = len(supply), len(demand)
    left, room = list(supply), list(demand)
    costs = [[cost(i, j) for j in range(m)] for i in range(n)]
    flow: dict[tuple[int, int], int] = {}
    potential = [0] * (n + m)
    while any(left):
        # Shortest path from any source with supply left to any target with room.
        dist = [0 if i < n and left[i] else None for i in range(n + m)]
        back: list[int | None] = [None] * (n + m)
        heap = [(0, i) for i in range(n) if left[i]]
        done = [False] * (n + m)
        while heap:
            d, u = heapq.heappop(heap)
            if done[u]:
                continue
            done[u] = True
            if u < n:
                steps = ((n + j, costs[u][j]) for j in range(m))
            else:
                steps = ((i, -costs[i][u - n]) for i in range(n) if flow.get((i, u - n), 0))
            for v, c in steps:
                through = d + c + potential[u] - potential[v]
                if not done[v] and (dist[v] is None or through < dist[v]):
                    dist[v], back[v] = through, u
                    heapq.heappush(heap, (through, v))
        far = max(d for d in dist if d is not None)
        potential = [p + (far if d is None else d) for p, d in zip(potential, dist, strict=True)]
        end = min((n + j for j in range(m) if room[j] and dist[n + j] is not None), key=lambda v: (dist[v] + 0, v))
        path = [end]
        while back[path[-1]] is not None:
            path.append(back[path[-1]])
        path.reverse()
        hops = list(zip(path, path[1:], strict=False))
        amount = min([left[path[0]], room[end - n], *(flow[(v, u - n)] for u, v in hops if u >= n)])
        for u, v in hops:
            key, sign = ((u, v - n), 1) if u < n else ((v, u - n), -1)
            flow[key] = flow.get(key, 0) + sign * amount
            if not flow[key]:
                del flow[key]
        left[path[0]] -= amount
        room[end - n] -= amount
    return flow


def fill(blocks: list[tuple[int, int]], amounts: dict[int, int]) -> tuple[dict[int, int], dict[int, int]]:
    """Assign the blocks of one old shard to targets: largest block first, to the target
    that lacks most. Returns block -> target, and what each target still lacks."""
    heap = [(-need, target) for target, need in amounts.items()]
    heapq.heapify(heap)
    placed = {}
    for size, block in sorted(((s, b) for b, s in blocks), key=lambda x: (-x[0], x[1])):
        need, target = heap[0]
        placed[block] = target
        heapq.heapreplace(heap, (need + size, target))
    return placed, {target: -need for need, target in heap}


@dataclass
class Plan:
    """flow: bytes from each old to each new shard; blocks: (old, block) -> (new, first slot)."""

    flow: dict[tuple[int, int], int]
    blocks: dict[tuple[int, int], tuple[int, int]]
    sizes: list[int]

    @property
    def moved(self) -> int:
        return sum(v for (i, j), v in self.flow.items() if i != j)

    @property
    def affected(self) -> set[int]:
        """New shards whose content differs from the old shard of the same number."""
        gone = {old for (old, _), (new, _) in self.blocks.items() if new != old}
        return gone | {new for (old, _), (new, _) in self.blocks.items() if new != old}


def plan(blocks: list[tuple[int, int, int, int]], n_old: int, n_new: int, cost=None, capacity=None) -> Plan:
    """Plan from (old shard, block, bytes, rows).

    ``capacity`` gives the bytes of each new shard; by default all are equal but for the
    remainder. ``cost(i, j)`` is the price of moving a byte; by default 0 where the shard
    keeps its number and 1 elsewhere, so the flow moves the fewest bytes.
    """
    old = [0] * n_old
    for i, _, size, _ in blocks:
        old[i] += size
    total = sum(old)
    capacity = capacity or [total // n_new + (j < total % n_new) for j in range(n_new)]
    flow = min_cost_flow(old, capacity, cost or (lambda i, j: int(i != j)))
    by_old: dict[int, list[tuple[int, int]]] = {}
    for i, b, size, _ in blocks:
        by_old.setdefault(i, []).append((b, size))
    place: dict[tuple[int, int], int] = {}
    lack = [0] * n_new  # what rounding to whole blocks has left open so far
    for i in sorted(by_old, key=lambda k: -old[k]):
        amounts = {j: v + lack[j] for (k, j), v in flow.items() if k == i}
        placed, rest = fill(by_old[i], amounts)
        place |= {(i, b): j for b, j in placed.items()}
        for j, v in rest.items():
            lack[j] = v
    sizes, rows, slots = [0] * n_new, [0] * n_new, {}
    counts = {(i, b): (size, n) for i, b, size, n in blocks}
    for key in sorted(place):
        j = place[key]
        slots[key] = (j, rows[j])
        sizes[j] += counts[key][0]
        rows[j] += counts[key][1]
    return Plan(flow, slots, sizes)


def reshard(df: DataFrame, old_shard: Column, size: Column, key: list[str], n_old: int, n_new: int,
            cost=None, capacity=None, blocks: int = BLOCKS) -> tuple[DataFrame, Plan]:
    """Rows with ``old_shard``, ``size``, ``shard`` and ``slot``, and the plan behind them.

    ``old_shard`` is a number from 0 to ``n_old - 1``; null counts as 0. ``size`` is in bytes;
    null counts as 0. Rows are told apart by ``key``; rows that agree in all of it are
    placed together and their slots follow in any order, which leaves the same set of
    (row, slot). Where many may agree, the key should hold where a row lies in its file. New columns replace those of the same name, and ``_block``, ``_part``, ``_at``
    and ``_first`` are not passed on. An empty table gives no rows. ``df`` is read once for the
    plan and once for the rows, which move in one shuffle, by parts of their new shard.
    """
    spark = df.sparkSession
    own = df.drop("shard", "slot", "_block", "_part", "_at", "_first").withColumns({
        "old_shard": F.coalesce(old_shard, F.lit(0)).cast("int"),
        "size": F.coalesce(size, F.lit(0)).cast("long"),
    }).withColumn("_block", F.pmod(F.xxhash64(*key), F.lit(blocks)).cast("int"))
    sums = own.groupBy("old_shard", "_block").agg(F.sum("size").alias("s"), F.count("*").alias("n"))
    found = [(r[0], r[1], r[2], r[3]) for r in sums.collect()]  # at most n_old x blocks rows
    made = plan(found, n_old, n_new, cost, capacity)
    moves = spark.createDataFrame(
        [(i, b, j, s) for (i, b), (j, s) in made.blocks.items()],
        "old_shard int, _block int, shard int, _first long",
    )
    placed = own.join(F.broadcast(moves), ["old_shard", "_block"])  # at most n_old x blocks rows
    dealt = placed.withColumn("_part", F.pmod("_block", F.lit(PARTS))).repartition("shard", "_part")
    within = F.row_number().over(Window.partitionBy("shard", "_part", "old_shard", "_block").orderBy(*key, "size")) - 1
    out = dealt.withColumn("_at", within).withColumn("slot", F.col("_first") + F.col("_at"))
    return out.drop("_first", "_at", "_block", "_part"), made


def rewrite(assigned: DataFrame, made: Plan, root: str | None = None) -> DataFrame:
    """Write the shards that change, each to its own new folder, and return the manifest
    (shard, folder). Shards that keep their rows are not read or written: their folder
    is null, which stands for the old file. Readers switch by the manifest, so a job
    that fails half-way leaves the old files in use."""
    spark = assigned.sparkSession
    root = root or fresh_path(spark, "shards")
    touched = sorted(made.affected)
    # reshard() has dealt the rows by parts of their shard.
    assigned.filter(F.col("shard").isin(touched)).drop("old_shard").write.partitionBy("shard").parquet(root)
    rows = [(j, f"{root}/shard={j}" if j in touched else None) for j in range(len(made.sizes))]
    return spark.createDataFrame(rows, "shard int, folder string")


def contents(assigned: DataFrame, made: Plan, manifest: DataFrame) -> DataFrame:
    """All rows as they lie after :func:`rewrite`, without ``old_shard``: those of the shards that
    changed from the manifest's files, those of the others from ``assigned``."""
    spark = assigned.sparkSession
    filled = {j for j, _ in made.blocks.values()}  # a shard that lost all its rows has no files
    folders = [r.folder for r in manifest.collect() if r.folder and r.shard in filled]  # one row per shard
    same = assigned.drop("old_shard")
    if not folders:
        return same
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in same.schema)
    found = spark.read.schema(names).option("basePath", folders[0].rpartition("/")[0]).parquet(*folders)
    kept = sorted(filled - made.affected)
    return found.unionByName(same.filter(F.col("shard").isin(kept))) if kept else found
