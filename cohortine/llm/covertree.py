"""Hard negatives by exact inner-product search in cover trees.

Vectors get one more coordinate that brings all norms of a block to the same value; a query
gets a zero there, so inner products stay. On that sphere a cover tree is built per block: the
centres of a level are picked farthest first, so they are at least as far apart as the radius
that covers their points, a centre is its own first child, and every node knows its covering
radius. Centre and radius bound the inner products of all points below a node from both sides.

A query descends best bound first. Nodes whose bounds lie outside all of its score windows,
or below the k-th score it already has in them, are skipped; the points of the leaves that
remain are scored exactly.

Rows are cut into blocks of one tree, queries into chunks. Blocks are searched in
rounds that grow eightfold, and the scores found so far go into the next round, so a block
far into the data only returns what beats them.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from ..session import materialise, release
from .base import ranges

#: Rows of one tree, queries of one chunk, points of a leaf, children of a node at most.
BLOCK, CHUNK, LEAF, FAN = 4096, 256, 24, 16
#: Nodes taken from the frontier at a time.
_STEP = 16
#: Bounds are widened by this share of the largest possible product, far above rounding.
_SLACK = 1e-6


def _narrow(values: np.ndarray) -> np.ndarray:
    for kind in (np.int16, np.int32):
        info = np.iinfo(kind)
        if not values.size or (values.min() >= info.min and values.max() <= info.max):
            return values.astype(kind)
    return values


@dataclass
class CoverTree:
    """Points in tree order; node ``i`` covers the points from ``start[i]`` to ``end[i]``."""

    ids: np.ndarray
    labels: np.ndarray
    points: np.ndarray
    norm: float
    centre: np.ndarray
    angle: np.ndarray
    start: np.ndarray
    end: np.ndarray
    child: np.ndarray
    children: np.ndarray


def build_tree(ids: np.ndarray, labels: np.ndarray, points: np.ndarray) -> CoverTree:
    n = len(ids)
    points = points.astype(np.float64)
    squares = np.einsum("ij,ij->i", points, points)
    norm = float(np.sqrt(squares.max())) if n else 0.0
    lift = np.sqrt(np.maximum(norm * norm - squares, 0))
    sphere = np.column_stack([points, lift])

    def away(members: np.ndarray, centre: int) -> np.ndarray:
        apart = sphere[members] - sphere[centre]
        return np.sqrt(np.einsum("ij,ij->i", apart, apart))

    centres, radii, starts, ends, child, children = [], [], [], [], [], []

    def add(centre: int, members: np.ndarray, start: int, distances: np.ndarray) -> int:
        centres.append(centre)
        radii.append(float(distances.max()))
        starts.append(start)
        ends.append(start + len(members))
        child.append(0)
        children.append(0)
        return len(centres) - 1

    order = np.zeros(n, np.int64)
    everyone = np.arange(n)
    first = away(everyone, 0) if n else np.zeros(0)
    todo = [(add(0, everyone, 0, first), everyone, first)] if n else []
    while todo:
        node, members, near = todo.pop()
        if len(members) <= LEAF or radii[node] == 0:
            order[starts[node] : ends[node]] = members
            continue
        # The next level halves the covering radius where FAN centres can do so.
        picked, owner, near = [centres[node]], np.zeros(len(members), np.int64), near.copy()
        while len(picked) < FAN and near.max() > radii[node] / 2:
            picked.append(int(members[near.argmax()]))
            distances = away(members, picked[-1])
            closer = distances < near
            owner[closer] = len(picked) - 1
            near[closer] = distances[closer]
        at = starts[node]
        child[node], children[node] = len(centres), len(picked)
        for i, centre in enumerate(picked):
            mine = owner == i
            todo.append((add(centre, members[mine], at, near[mine]), members[mine], near[mine]))
            at += int(mine.sum())
    chord = np.clip(np.array(radii) / (2 * norm), 0, 1) if norm else np.zeros(len(radii))
    place = np.zeros(n, np.int64)
    place[order] = np.arange(n)
    return CoverTree(
        ids[order],
        labels[order],
        _narrow(points[order]),
        norm,
        place[np.array(centres, np.int64)],
        2 * np.arcsin(chord),
        np.array(starts, np.int64),
        np.array(ends, np.int64),
        np.array(child, np.int64),
        np.array(children, np.int64),
    )


class Best:
    """The ``k`` best (score, id) of one query in each of its windows."""

    def __init__(self, low: np.ndarray, high: np.ndarray, need: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.need = np.maximum(low, need)
        self.scores = [np.zeros(0)] * len(low)
        self.ids = [np.zeros(0, np.int64)] * len(low)

    def useful(self, upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
        return ((upper[:, None] >= self.need) & (lower[:, None] <= self.high)).any(axis=1)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for w in range(len(self.low)):
            inside = (scores >= self.need[w]) & (scores <= self.high[w])
            if not inside.any():
                continue
            every = np.concatenate([self.scores[w], scores[inside]])
            names = np.concatenate([self.ids[w], ids[inside]])
            order = np.lexsort((names, -every))[: self.k]
            self.scores[w], self.ids[w] = every[order], names[order]
            if len(order) == self.k:
                self.need[w] = max(self.need[w], self.scores[w][-1])


def search(
    tree: CoverTree, points: np.ndarray, query: np.ndarray, own: int, label: int, same: bool, best: Best
) -> None:
    """Offer ``best`` all points of a window in reach, of the same or of other labels."""
    if not len(tree.ids):
        return
    length = float(np.sqrt(query @ query))
    scale = length * tree.norm
    slack = _SLACK * scale + 1e-9

    def bounds(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not scale:
            return np.zeros(len(nodes)), np.zeros(len(nodes))
        theta = np.arccos(np.clip(points[tree.centre[nodes]] @ query / scale, -1, 1))
        upper = np.cos(np.maximum(theta - tree.angle[nodes], 0)) * scale + slack
        lower = np.cos(np.minimum(theta + tree.angle[nodes], np.pi)) * scale - slack
        return upper, lower

    nodes = np.zeros(1, np.int64)
    upper, lower = bounds(nodes)
    while True:
        keep = best.useful(upper, lower)
        nodes, upper, lower = nodes[keep], upper[keep], lower[keep]
        if not len(nodes):
            return
        order = np.argsort(-upper, kind="stable")
        taken, rest = nodes[order[:_STEP]], order[_STEP:]
        nodes, upper, lower = nodes[rest], upper[rest], lower[rest]
        leaf = tree.children[taken] == 0
        begin = tree.start[taken[leaf]]
        at = ranges(begin, tree.end[taken[leaf]] - begin)
        at = at[((tree.labels[at] == label) == same) & (tree.ids[at] != own)]
        if len(at):
            best.add(points[at] @ query, tree.ids[at])
        inner = taken[~leaf]
        if len(inner):
            below = ranges(tree.child[inner], tree.children[inner])
            more, less = bounds(below)
            nodes = np.concatenate([nodes, below])
            upper, lower = np.concatenate([upper, more]), np.concatenate([lower, less])


def _packed(
    rows: DataFrame, dims: int, size: int, count: int, trees: bool, key: str
) -> DataFrame:
    """Rows of (id, label, vector) as pieces of ``size``, neighbours in label together.

    The rows are numbered in order of label, so the pieces do not depend on how they lie in
    partitions.
    """
    spotted = rows.withColumn("spot", F.xxhash64("id", "vector"))
    numbered = number_rows(spotted, ["label", "spot", "id", "vector"], "number")
    parts = max(1, -(-count // size))
    ordered = (
        numbered.select(F.expr(f"(number - 1) div {size}").alias("piece"), "id", "label", "vector")
        .repartition(parts, "piece")
        .sortWithinPartitions("piece", "label", "id")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            pieces = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(pieces)) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:]):
                if end == start:
                    continue
                if held and pieces[start] != last:
                    yield piece(held)
                    held = []
                last = pieces[start]
                held.append(batch.slice(start, end - start))
        if held:
            yield piece(held)

    def piece(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        ids, labels = table["id"].to_numpy(), table["label"].to_numpy()
        lists = table["vector"].chunk(0)
        sizes = np.diff(lists.offsets.to_numpy())
        points = np.zeros((len(ids), dims))
        row = np.repeat(np.arange(len(ids)), sizes)
        points[row, ranges(np.zeros(len(ids), np.int64), sizes)] = lists.flatten().to_numpy()
        content = build_tree(ids, labels, points) if trees else (ids, labels, _narrow(points))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([np.unique(labels).tolist()], pa.list_(pa.int64())),
                pa.array([pickle.dumps(content)], pa.binary()),
            ],
            names=["labels", key + "_data"],
        )

    packed = ordered.mapInArrow(pack, f"labels array<bigint>, {key}_data binary")
    return materialise(packed.select(F.monotonically_increasing_id().alias(key), "*"))


def _search_round(
    pairs: DataFrame, blocks: DataFrame, chunks: DataFrame, windows: DataFrame, same: bool, k: int, n: int
) -> DataFrame:
    """The rows that every block of ``pairs`` offers to the windows of its chunk."""
    lists = windows.groupBy("chunk").agg(
        F.collect_list(F.struct("at", "w", "low", "high", "need")).alias("windows")
    )
    work = (
        pairs.join(lists, "chunk")
        .join(chunks.select("chunk", "chunk_data"), "chunk")
        .join(blocks.select("block", "block_data"), "block")
        .repartition(n, "chunk", "block")
        .select("chunk", "chunk_data", "block_data", "windows")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids, labels, queries = pickle.loads(row.column(1)[0].as_py())
                tree: CoverTree = pickle.loads(row.column(2)[0].as_py())
                points, queries = tree.points.astype(np.float64), queries.astype(np.float64)
                asked = row.column(3).flatten()
                at, w, low, high, need = (
                    asked.field(j).to_numpy(zero_copy_only=False) for j in range(5)
                )
                order = np.argsort(at, kind="stable")
                groups = np.split(order, np.flatnonzero(np.diff(at[order])) + 1)
                here = set(tree.labels.tolist())
                out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
                for group in groups:
                    q = int(at[group[0]])
                    if same and int(labels[q]) not in here:
                        continue
                    best = Best(low[group], high[group], need[group], k)
                    search(tree, points, queries[q], int(ids[q]), int(labels[q]), same, best)
                    for j, one in enumerate(group.tolist()):
                        out.append((q, int(w[one]), best.scores[j], best.ids[j]))
                sizes = np.array([len(scores) for _, _, scores, _ in out], np.int64)
                total = int(sizes.sum())
                columns = [
                    np.full(total, row.column(0)[0].as_py(), np.int64),
                    np.repeat(np.array([o[0] for o in out], np.int32), sizes),
                    np.repeat(np.array([o[1] for o in out], np.int32), sizes),
                    np.concatenate([o[2] for o in out] or [np.zeros(0)]),
                    np.concatenate([o[3] for o in out] or [np.zeros(0, np.int64)]),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["chunk", "at", "w", "score", "id"]
                )

    return work.mapInArrow(run, "chunk bigint, at int, w int, score double, id bigint")


def _search_all(
    blocks: DataFrame, chunks: DataFrame, windows: DataFrame, same: bool, k: int
) -> DataFrame:
    """The ``k`` best rows of every window over all blocks, as chunk, at, w, place, score, id."""
    n_blocks, n_chunks = blocks.count(), chunks.count()
    names = blocks.select("block", F.explode("labels").alias("label"))
    asked = chunks.select("chunk", F.explode("labels").alias("label"))
    if same:
        pairs = names.join(asked, "label").select("chunk", "block").distinct()
    else:  # the stated queries, in chunks, against all rows, in blocks
        pairs = chunks.select("chunk").crossJoin(blocks.select("block"))
    spot = F.pmod(F.xxhash64("block"), F.lit(1 << 30)) / (1 << 30)
    nearest = Window.partitionBy("chunk", "at", "w").orderBy(F.desc("score"), "id")
    found: DataFrame | None = None
    low, high = 0.0, 2.0 / max(n_blocks, 1)
    while low < 1:
        now = windows
        if found is not None:
            kth = found.where(F.col("place") == k).select("chunk", "at", "w", F.col("score").alias("kth"))
            now = windows.join(kth, ["chunk", "at", "w"], "left").withColumn(
                "need", F.coalesce("kth", "need")
            )
        part = pairs.where((spot >= low) & (spot < high))
        n = max(1, int(min(high, 1.0) * n_blocks * n_chunks) // 8)
        hits = _search_round(part, blocks, chunks, now, same, k, max(n, 8))
        every = hits if found is None else found.drop("place").unionByName(hits)
        best = materialise(
            every.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k)
        )
        if found is not None:
            release(found)
        found, low, high = best, high, high * 8
    return found


def mine_hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    n_positives: int = 5,
    k: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "vector",
) -> DataFrame:
    """For every anchor and each of its positives, the best rows of other labels in a window.

    ``rows`` have a ``bigint`` id, an integer label and an integer vector
    (``array<bigint>``); ``is_anchor`` is a condition on them. The score of two rows is their
    inner product; higher comes first, the smaller id on a tie. Positives are the first
    ``n_positives`` other rows of the anchor's label; negatives the first ``k`` rows of other
    labels with ``low_percent * p <= 100 * score <= high_percent * p`` for the positive's score
    ``p``. Returns ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score``, ``negative_score``.

    Rows with a null id, label, vector or element take no part. Repeated rows count once.
    Rows of one id with different vectors or labels are separate rows, but never the positives or
    negatives of each other. Shorter vectors are filled with zeros. Anchors without a
    positive, and positives without a row in their window, give no rows. Scores are exact
    up to 2^53. Other columns are not read. An empty table gives no rows.
    """
    clean = materialise(
        rows.select(
            F.col(id_col).cast("bigint").alias("id"),
            F.col(label_col).cast("bigint").alias("label"),
            F.col(vector_col).cast("array<double>").alias("vector"),
            F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        )
        .where(~F.exists("vector", lambda x: x.isNull()))
        .dropna()
        .distinct()
    )
    count, n_anchors, dims = clean.agg(
        F.count(F.lit(1)),
        F.count_if("anchor"),
        F.coalesce(F.max(F.size("vector")), F.lit(0)),
    ).first()
    plain = clean.select("id", "label", "vector")
    blocks = _packed(plain, dims, BLOCK, count, True, "block")
    chunks = _packed(
        clean.where("anchor").select("id", "label", "vector"), dims, CHUNK, n_anchors, False, "chunk"
    )

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = pickle.loads(data.as_py())[0]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), chunk, np.int64)),
                        pa.array(np.arange(len(ids), dtype=np.int32)),
                        pa.array(ids),
                    ],
                    names=["chunk", "at", "anchor_id"],
                )

    anchors = materialise(
        chunks.select("chunk", "chunk_data").mapInArrow(
            members, "chunk bigint, at int, anchor_id bigint"
        )
    )
    nothing, everything = F.lit(float("-inf")), F.lit(float("inf"))
    open_windows = anchors.select(
        "chunk",
        "at",
        F.lit(0).alias("w"),
        nothing.alias("low"),
        everything.alias("high"),
        nothing.alias("need"),
    )
    positives = _search_all(blocks, chunks, open_windows, True, n_positives).select(
        "chunk",
        "at",
        F.col("place").alias("w"),
        F.col("id").alias("positive_id"),
        F.col("score").cast("bigint").alias("positive_score"),
    )

    def floor_share(percent: int) -> str:
        product = f"({percent} * positive_score)"
        return f"({product} - pmod({product}, 100)) div 100"

    negative_low = f"-({floor_share(-low_percent)})"
    windows = positives.select(
        "chunk",
        "at",
        "w",
        F.expr(negative_low).cast("double").alias("low"),
        F.expr(floor_share(high_percent)).cast("double").alias("high"),
        nothing.alias("need"),
    ).where("low <= high")
    negatives = _search_all(blocks, chunks, windows, False, k)
    return (
        negatives.join(positives, ["chunk", "at", "w"])
        .join(anchors, ["chunk", "at"])
        .select(
            "anchor_id",
            "positive_id",
            F.col("place").alias("rank"),
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").cast("bigint").alias("negative_score"),
        )
    )


def scaled_floor(vector: str, scale: int) -> Column:
    """Elements times ``scale``, rounded down, as integers; null for a null or non-finite one."""
    element = f"transform({vector}, x -> CAST(x AS DOUBLE))"
    whole = F.expr(f"transform({element}, x -> CAST(floor({scale} * x) AS BIGINT))")
    finite = F.expr(
        f"NOT exists({element}, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))"
    )
    return F.when(finite, whole)
