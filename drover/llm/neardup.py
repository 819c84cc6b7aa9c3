"""Near-duplicate groups by one-permutation MinHash.

Equal shingle sets are one node. Signatures come from one permutation with optimal
densification; bands of them are buckets; each bucket contributes stars of candidate
edges around the members that agree best with the rest, and joins the stars between which
a link is possible, so candidates grow linearly with the members and hold together all
that may be linked. Every candidate is confirmed on the full sets, and groups that the
candidates hold together but the links do not are compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover.llm import shingles as S
from drover.llm.base import extended, schema_of, text_column
from drover.llm.components import components
from drover.session import materialize

#: Members of a bucket, or of a star, that one task takes at a time; a larger bucket is cut
#: into chunks, each held together as a whole, whose centres meet again; a larger star
#: repeats its centre.
CHUNK = 4096
STAR = 512
#: Members of a group whose texts are compared at a time when components in it may still be linked.
CROSS = 512
#: Sets of this size at least are judged by their signatures first: where these agree in less
#: than the wanted similarity minus the margin, five standard deviations, a link is out of the
#: question. Smaller sets are always confirmed.
SURE_SIZE, MARGIN = 96, 0.22


def _signed(df: DataFrame, keep: list[str], text: str, width: int) -> DataFrame:
    read, thin = text_column(df, keep, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, nodes, sigs = [], [], [], []
            for value in batch.column(read):
                found = S.shingles(value.as_py(), width)
                sizes.append(len(found))
                own = S.digest(found) if len(found) else None
                digests.append(own)
                nodes.append(int.from_bytes(own[:8], "little", signed=True) if own else None)
                sigs.append(S.signature(found).tobytes() if own else None)
            yield extended(batch, keep, n_shingles=pa.array(sizes, pa.int64()), node=pa.array(nodes, pa.int64()),
                           sig=pa.array(sigs, pa.binary()))

    return thin.mapInArrow(run, schema_of(thin, keep, "n_shingles long, node long, sig binary"))


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = batch.column("node").to_numpy(zero_copy_only=False)
        found = [S.bands(np.frombuffer(s.as_py(), np.uint32)) for s in batch.column("sig")]
        flat = np.concatenate(found) if found else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(np.repeat(nodes, S.BANDS))], names=["bucket", "node"])


def _centre(sigs: np.ndarray) -> int:
    """The member that agrees with most of the members in most of the bins."""
    agree = np.zeros(len(sigs), np.int64)
    for column in sigs.T:
        values, at, counts = np.unique(column, return_inverse=True, return_counts=True)
        agree += counts[at]
    return int(agree.argmax())


def stars(nodes: np.ndarray, sizes: np.ndarray, sigs: np.ndarray, percent: int, whole: bool = False) -> tuple[list[tuple[int, int]], int]:
    """Candidate edges of the members of a bucket, less than two per member, and the first centre.

    Members that cannot be linked with the centre form the next star. A member that is
    probably not linked with its centre is also paired with the member nearest to it. What
    the edges then leave apart is joined wherever two members may be linked; ``whole``
    joins it in any case.
    """
    wanted, least = percent / 100, percent / 100 - MARGIN
    edges, first = [], None
    order = np.argsort(nodes)
    nodes, sizes, sigs = nodes[order], sizes[order], sigs[order]
    active, apart = np.arange(len(nodes)), []

    def plausible(a: int, others: np.ndarray, agree: np.ndarray) -> np.ndarray:
        small, large = np.minimum(sizes[others], sizes[a]), np.maximum(sizes[others], sizes[a])
        return (100 * small >= percent * large) & ((agree >= least) | (small < SURE_SIZE))

    while len(active):
        centre = int(active[_centre(sigs[active])]) if len(active) > 2 else int(active[0])
        first = int(nodes[centre]) if first is None else first
        others = active[active != centre]
        agree = (sigs[others] == sigs[centre]).mean(axis=1)
        near = plausible(centre, others, agree)
        edges += [(int(nodes[centre]), int(nodes[b])) for b in others[near]]
        apart += others[near & (agree < wanted)].tolist()
        if not near.any():  # an outlier, or nobody has company here
            apart.append(centre)
        active = others[~near]
        if len(active) and near.sum() * 8 < len(active):
            apart += active.tolist()  # many strangers: each looks for its nearest
            break
    for x in apart if len(nodes) > 2 else ():
        others = np.flatnonzero(np.arange(len(nodes)) != x)
        agree = (sigs[others] == sigs[x]).mean(axis=1)
        agree[~plausible(x, others, agree)] = -1
        best = int(agree.argmax())
        if agree[best] >= 0:
            edges.append((int(nodes[x]), int(nodes[others[best]])))
    return edges + _joins(nodes, edges, sigs, plausible, whole), first


def _joins(nodes: np.ndarray, edges: list[tuple[int, int]], sigs: np.ndarray, plausible, whole: bool) -> list[tuple[int, int]]:
    """Edges between members that may be linked and that ``edges`` leave apart: the likeliest
    of each pair of parts, one less in all than the parts. Every such pair has an end outside
    the largest part, so only members outside it look around."""
    ends = np.searchsorted(nodes, np.array(edges, np.int64).reshape(-1, 2))
    root = list(range(len(nodes)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in ends.tolist():
        root[find(a)] = find(b)
    part = np.array([find(x) for x in range(len(nodes))], np.int64)
    if len(np.unique(part)) < 2:
        return []
    out = []
    largest = np.bincount(part).argmax()
    for x in np.flatnonzero(part != largest).tolist():
        others = np.flatnonzero(part != part[x])
        agree = (sigs[others] == sigs[x]).mean(axis=1)
        may = plausible(x, others, agree)
        others, agree = others[may], agree[may]
        for b in others[np.argsort(-agree, kind="stable")].tolist():
            if part[b] != part[x]:
                out.append((int(nodes[x]), int(nodes[b])))
                part[part == part[b]] = part[x]
    if whole:
        first = [int(np.flatnonzero(part == p)[0]) for p in np.unique(part)]
        out += [(int(nodes[first[0]]), int(nodes[b])) for b in first[1:]]
    return out


def _starred(percent: int, again: bool):
    """``again``: the members are the centres of chunks of one bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows of the group that the last batch ended in
        key = None

        def close(out: list) -> None:
            if len(held) > 1 or (held and held[0][4] > 1):
                nodes = np.array([r[2] for r in held], np.int64)
                sigs = np.frombuffer(b"".join(r[5] for r in held), np.uint8).reshape(len(held), -1)
                edges, first = stars(nodes, np.array([r[3] for r in held]), sigs, percent, again or held[0][4] > 1)
                out.extend((a, b, None) for a, b in edges)
                if held[0][4] > 1:  # one of several chunks: its centre meets the others
                    out.append((first, None, held[0][0]))

        def batch_of(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["a", "b", "bucket"])

        for batch in batches:
            out: list = []
            columns = [batch.column(n).to_pylist() for n in ("bucket", "chunk", "node", "n_shingles", "chunks", "sig8")]
            for row in zip(*columns, strict=True):
                if (row[0], row[1]) != key:
                    close(out)
                    held.clear()
                    key = (row[0], row[1])
                held.append(row)
            if out:
                yield batch_of(out)
        out = []
        close(out)
        if out:
            yield batch_of(out)

    return run


def candidates(nodes: DataFrame, percent: int) -> DataFrame:
    """Candidate edges (a, b) from nodes with (node, n_shingles, sig). Buckets of one member
    are dropped before anything but two numbers per band is moved."""
    rows = nodes.select("node", "sig").mapInArrow(_banded, "bucket long, node long")
    small = nodes.select("node", "n_shingles", F.col("sig8"))
    found, level = [], materialize(rows, "bands")
    while True:
        sizes = level.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
        sizes = sizes.withColumn("chunks", F.ceil(F.col("n") / F.lit(CHUNK)).cast("long"))
        joined = level.join(sizes, "bucket").join(small, "node")
        dealt = joined.withColumn("chunk", F.pmod(F.xxhash64("node", "bucket"), F.col("chunks")))
        dealt = dealt.select("bucket", "chunk", "node", "n_shingles", "chunks", "sig8")
        dealt = dealt.repartition("bucket", "chunk").sortWithinPartitions("bucket", "chunk")
        out = materialize(dealt.mapInArrow(_starred(percent, bool(found)), "a long, b long, bucket long"), "stars")
        found.append(out.filter("b IS NOT NULL").select("a", "b"))
        centres = out.filter("bucket IS NOT NULL").select("bucket", F.col("a").alias("node"))
        if centres.isEmpty():
            break
        level = centres
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges.distinct()


def _confirmed(width: int, percent: int):
    """Rows of a star arrive together, the centre first: (hub, chunk, role, node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, centre = None, None
        for batch in batches:
            out = []
            hubs, chunks = batch.column("hub").to_pylist(), batch.column("chunk").to_pylist()
            roles, nodes = batch.column("role").to_pylist(), batch.column("node").to_pylist()
            for k, (hub, chunk, role, node) in enumerate(zip(hubs, chunks, roles, nodes, strict=True)):
                found = S.shingles(batch.column("text")[k].as_py(), width)
                if int.from_bytes(S.digest(found)[:8], "little", signed=True) != node:
                    continue  # another text under the same key
                if role == 0:
                    key, centre = (hub, chunk), found
                elif key == (hub, chunk) and S.similar(centre, found, percent):
                    out.append((hub, node))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return run


def confirm(edges: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The edges whose full sets are similar enough. The end of an edge that occurs in more
    edges is its centre; each star of up to :data:`STAR` members brings its texts together."""
    degree = edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
    d = lambda end: degree.select(F.col("node").alias(end), F.col("degree").alias(f"d{end}"))
    swap = (F.col("db") > F.col("da")) | ((F.col("db") == F.col("da")) & (F.col("b") < F.col("a")))
    turned = edges.join(d("a"), "a").join(d("b"), "b").select(
        F.when(swap, F.col("b")).otherwise(F.col("a")).alias("hub"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("node")
    ).distinct()
    turned = materialize(turned, "edges")
    counts = turned.groupBy("hub").agg(F.ceil(F.count("*") / F.lit(STAR)).cast("long").alias("chunks"))
    members = turned.join(counts, "hub").select(
        "hub", F.pmod(F.xxhash64("node"), F.col("chunks")).alias("chunk"), F.lit(1).alias("role"), "node")
    centres = counts.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"),
                            F.lit(0).alias("role"), F.col("hub").alias("node"))
    rows = members.unionByName(centres).join(texts, "node").select("hub", "chunk", "role", "node", "text")
    rows = rows.repartition("hub", "chunk").sortWithinPartitions("hub", "chunk", "role")
    return rows.mapInArrow(_confirmed(width, percent), "a long, b long")


def _linked(nodes: list[int], labels: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between members with different labels, by an inverted index over their shingles;
    of the links between two labels, the first that joins what is not joined yet."""
    size = np.array([len(x) for x in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    label = np.array(labels)
    values, counts = np.unique(label, return_counts=True)
    most = values[counts.argmax()]
    root = {v: v for v in values.tolist()}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    out = []
    for i in np.flatnonzero(label != most).tolist():  # every link across labels has an end outside the largest
        begin, end = np.searchsorted(flat, sets[i], "left"), np.searchsorted(flat, sets[i], "right")
        both = np.zeros(len(sets), np.int64)
        np.add.at(both, np.concatenate([owner[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]), 1)
        for j in np.flatnonzero((100 * both >= percent * (size[i] + size - both)) & (label != label[i])).tolist():
            x, y = find(labels[i]), find(labels[j])
            if x != y:
                root[x] = y
                out.append((nodes[i], nodes[j]))
    return out


def _crossed(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}

        def close() -> list[tuple[int, int]]:
            if len({x[0] for x in held.values()}) < 2:
                return []
            return _linked(list(held), [x[0] for x in held.values()], [x[1] for x in held.values()], percent)

        def batch_of(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            out = []
            columns = [batch.column(n).to_pylist() for n in ("part", "low", "high", "node", "label")]
            for k, (part, low, high, node, label) in enumerate(zip(*columns, strict=True)):
                if (part, low, high) != key:
                    out += close()
                    held.clear()
                    key = (part, low, high)
                if node not in held:
                    found = S.shingles(batch.column("text")[k].as_py(), width)
                    if int.from_bytes(S.digest(found)[:8], "little", signed=True) == node:
                        held[node] = (label, found)
            if out:
                yield batch_of(out)
        if out := close():
            yield batch_of(out)

    return run


def across(edges: DataFrame, links: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links that no star has offered. A group is what the candidates hold together; where
    the confirmed links leave several components in one, the members outside the largest
    are compared with each other and with those of the largest, :data:`CROSS` with as many
    others at a time. Only links that join components come out."""
    groups = components(edges).select("node", F.col("root").alias("part"))
    labels = components(links).select("node", F.col("root").alias("label"))
    members = groups.join(labels, "node", "left").select("part", "node", F.coalesce("label", "node").alias("label"))
    members = materialize(members, "members")
    sizes = members.groupBy("part", "label").agg(F.count("*").alias("n"))
    sums = sizes.groupBy("part").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("most"))
    mixed = sums.filter("n > most.n").select(
        "part", F.col("most.label").alias("most"), F.ceil((F.col("n") - F.col("most.n")) / F.lit(CROSS)).cast("long").alias("strays"),
        F.ceil(F.col("most.n") / F.lit(CROSS)).cast("long").alias("others"))
    dealt = members.join(mixed, "part").withColumn("stray", F.col("label") != F.col("most"))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("node"), F.when(F.col("stray"), F.col("strays")).otherwise(F.col("others"))))
    # Chunks of strays are numbered from 0, those of the largest component from -1 down. A stray
    # meets both, a member of the largest component the strays only.
    strays = F.sequence(F.lit(0).cast("long"), F.col("strays") - 1)
    other = F.when(F.col("stray"), F.concat(strays, F.sequence(-F.col("others"), F.lit(-1).cast("long")))).otherwise(strays)
    own = F.when(F.col("stray"), F.col("chunk")).otherwise(-1 - F.col("chunk"))
    dealt = dealt.select("part", own.alias("chunk"), F.explode(other).alias("other"), "node", "label").select(
        "part", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "node", "label")
    rows = dealt.join(texts, "node").repartition("part", "low", "high").sortWithinPartitions("part", "low", "high")
    return rows.mapInArrow(_crossed(width, percent), "a long, b long")


def texts_of(edges: DataFrame, nodes: DataFrame, df: DataFrame, key: str, text: str) -> DataFrame:
    """(node, text) of every end of an edge, written once, so that all texts are shuffled once only."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = ends.join(nodes.select("node", F.col("rep").alias("_rep")), "node")
    own = df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("text"))
    return materialize(wanted.join(own, F.col("_rep").eqNullSafe(F.col("_key"))).select("node", "text"), "texts")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, percent: int = 85) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row.

    Rows are linked where 100 x intersection >= ``percent`` x union of their shingle sets;
    ``component_id`` is the least key reachable and ``kept`` marks the row that bears it.
    A null or blank text has an empty set, is linked with nothing and is kept. Rows whose
    key repeats are kept or dropped together. Null keys are never the least of a group
    with other keys; such a row is kept only where its group has no key at all.
    """
    signed = materialize(_signed(df.select(key, F.col(text).alias("text")) if text != "text" else df.select(key, "text"), [key], "text", width), "signed")
    sets = signed.filter("node IS NOT NULL")
    nodes = sets.groupBy("node").agg(F.min(key).alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
    nodes = materialize(nodes.withColumn("sig8", _low_bytes("sig")), "nodes")
    edges = materialize(candidates(nodes, percent), "candidates")
    texts = texts_of(edges, nodes, df, key, text)
    links = materialize(confirm(edges, texts, width, percent), "links")
    roots = components(links.unionByName(across(edges, links, texts, width, percent)))
    reps = nodes.select("node", "rep")
    grouped = roots.join(reps, "node").groupBy("root").agg(F.min("rep").alias("_least"))
    of_node = roots.join(grouped, "root").select("node", "_least")
    labels = reps.join(of_node, "node", "left").select("node", F.coalesce("_least", "rep").alias("component_id"))
    out = signed.select(key, "n_shingles", "node").join(labels, "node", "left")
    own = F.when(F.col("node").isNull(), F.col(key)).otherwise(F.col("component_id"))
    return out.select(key, "n_shingles", own.alias("component_id"), F.col(key).eqNullSafe(own).alias("kept"))


def _low_bytes(name: str):
    """Every fourth byte of a signature: eight bits per bin."""
    return F.unhex(F.regexp_replace(F.hex(name), "(..)......", "$1"))
