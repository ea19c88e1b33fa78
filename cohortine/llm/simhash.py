"""Near-duplicate documents by SimHash and the general pigeonhole principle.

1. Every text gets a 64-bit fingerprint.
2. Distinct fingerprints only go on, so copies cost nothing however many there are.
3. Correlated bits are grouped into partitions. If the thresholds ``t`` of ``m``
   partitions add up to ``max_distance - m + 1``, two fingerprints within the distance
   differ by at most ``t[i]`` bits in some partition ``i``. Dynamic programming picks
   the thresholds with the least estimated work from counts over all fingerprints; a
   threshold of -1 leaves a partition out.
4. Each fingerprint probes the values within the threshold, and the whole distance is
   verified inside the join, so only true links leave it.
5. Links become components by label contraction on Spark tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise, release
from .base import slices, utf8

BITS = 64
#: Hashes whose bits are counted at a time.
_BLOCK = 1 << 16
#: Work of verifying one candidate pair against that of shuffling one probe row.
CANDIDATE_COST = 0.05


def fingerprint(text: bytes, words_per_shingle: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles of a text, repeats included; 0 without a word."""
    words = text.lower().split()  # bytes: only A-Z change, only ASCII space separates
    if not words:
        return 0
    k = min(words_per_shingle, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = (starts + lengths)[k - 1 :]
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    n = len(ends)
    for at in range(0, n, _BLOCK):
        spans = zip(starts[at : at + _BLOCK].tolist(), ends[at : at + _BLOCK].tolist())
        hashes = np.array([digest(view[a:b], seed) for a, b in spans], np.uint64)
        rows = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3
) -> DataFrame:
    """``id_col`` and the fingerprint as a signed ``bigint`` for every row of ``docs``."""
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("__fp", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = [fingerprint(text, words_per_shingle) for text in utf8(batch.column(1))]
            column = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def bit_moments(codes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of codes, and for every two bits in how many codes both are set.

    Each task sends its 64 x 64 counts to a sum by cell; 4096 numbers reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, both = 0, np.zeros((BITS, BITS), np.int64)
        for batch in slices(batches, 1 << 14):
            codes = batch.column(0).to_numpy(zero_copy_only=False).astype(">i8")
            bits = np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1).astype(np.float32)
            both += np.rint(bits.T @ bits).astype(np.int64)
            total += len(codes)
        cells = np.append(both.ravel(), total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "n"]
        )

    summed = codes.mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = dict(map(tuple, summed.collect()))
    both = np.array([counts.get(i, 0) for i in range(BITS * BITS)]).reshape(BITS, BITS)
    return counts.get(BITS * BITS, 0), both


def partition_bits(total: int, both: np.ndarray, m: int) -> list[list[int]]:
    """``m`` groups of bit numbers (0 is the highest) with high correlation inside.

    Greedy: a group starts with the free bit of strongest total correlation and takes
    the free bit most correlated with it until it has its share of the 64 bits.
    """
    p = both.diagonal() / max(total, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    correlation = np.abs(both / max(total, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(correlation, 0)
    free, groups = list(range(BITS)), []
    for k in range(m):
        size = BITS // m + (k < BITS % m)
        group = [max(free, key=lambda b: (correlation[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < size:
            best = max(free, key=lambda b: (correlation[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def part_value(code: Column, bits: Sequence[int]) -> Column:
    """The chosen bits of a code, packed into the low bits of a ``bigint``."""
    out = F.lit(0).cast("bigint")
    for place, bit in enumerate(bits):
        one = F.shiftrightunsigned(code, BITS - 1 - bit).bitwiseAND(F.lit(1).cast("bigint"))
        out = out.bitwiseOR(F.shiftleft(one, place))
    return out


def allocate(costs: Sequence[Sequence[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds from -1 up that add up to ``total`` at the least cost.

    ``costs[i][t + 1]`` is the cost of threshold ``t`` in partition ``i``.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for step, more in enumerate(row):
                candidate = (cost + more, [*chosen, step - 1])
                if used + step - 1 not in following or candidate < following[used + step - 1]:
                    following[used + step - 1] = candidate
        best = following
    return best[total]


def plan(codes: DataFrame, max_distance: int) -> list[tuple[list[int], int]]:
    """Partitions and their thresholds with the least estimated work.

    Pairs with equal bits in a partition are counted over all codes; those within a
    larger radius are estimated from the ratio of one-bit differences to agreements of
    independent bits. The number of partitions is chosen the same way.
    """
    total, both = bit_moments(codes)
    p = both.diagonal() / max(total, 1)
    options = {m: partition_bits(total, both, m) for m in range(2, max_distance + 2)}
    if max_distance == 0:
        options = {1: [list(range(BITS))]}
    named = [(f"{m}_{i}", bits) for m, groups in options.items() for i, bits in enumerate(groups)]
    # One pass: rows (partition, value, n), then the sum of n * n by partition.
    values = codes.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("part"), part_value(F.col("__fp"), bits).alias("v"))
                    for name, bits in named
                ]
            )
        ).alias("e")
    ).select("e.*")
    equal = dict(
        map(
            tuple,
            values.groupBy("part", "v")
            .count()
            .groupBy("part")
            .agg(F.sum(F.col("count").cast("double") * F.col("count")))
            .collect(),
        )
    )
    chosen: tuple[float, list[tuple[list[int], int]]] | None = None
    for m, groups in options.items():
        costs = []
        for i, bits in enumerate(groups):
            agree = p[bits] ** 2 + (1 - p[bits]) ** 2
            ratios = np.array([1.0])
            for ratio in (1 - agree) / agree:
                ratios = np.convolve(ratios, [1.0, ratio])
            row = [0.0]
            for t in range(max_distance - m + 2):
                probes = total * sum(comb(len(bits), e) for e in range(t + 1))
                pairs = equal.get(f"{m}_{i}", 0.0) * ratios[: t + 1].sum()
                row.append(total + probes + CANDIDATE_COST * pairs)
            costs.append(row)
        cost, thresholds = allocate(costs, max_distance - m + 1)
        if chosen is None or cost < chosen[0]:
            chosen = (cost, list(zip(groups, thresholds)))
    assert chosen is not None
    return [(bits, t) for bits, t in chosen[1] if t >= 0]


def _masks(width: int, radius: int) -> list[int]:
    return [
        reduce(lambda mask, b: mask | 1 << b, bits, 0)
        for e in range(radius + 1)
        for bits in combinations(range(width), e)
    ]


def links(codes: DataFrame, max_distance: int = 3) -> DataFrame:
    """Pairs ``a < b`` of distinct codes in column ``__fp`` within ``max_distance`` bits."""
    code = F.col("__fp")
    parts = plan(codes, max_distance)
    valued = codes.select(
        code.alias("code"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("part"), part_value(code, bits).alias("v"))
                    for i, (bits, _) in enumerate(parts)
                ]
            )
        ).alias("e"),
    ).select("code", "e.part", "e.v")
    index = valued.withColumnRenamed("code", "b")
    masks = F.array(
        *[F.array(*[F.lit(x).cast("bigint") for x in _masks(len(bits), t)]) for bits, t in parts]
    )
    probes = valued.select(
        F.col("code").alias("a"), "part", "v", F.explode(F.get(masks, F.col("part"))).alias("mask")
    ).select("a", "part", F.col("v").bitwiseXOR(F.col("mask")).alias("v"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    return (
        # The probes are many times larger than the planner can know: never broadcast.
        probes.hint("merge")
        .alias("p")
        .join(
            index.alias("i"),
            (F.col("p.part") == F.col("i.part"))
            & (F.col("p.v") == F.col("i.v"))
            & (F.col("a") < F.col("b"))
            & near,
        )
        .select("a", "b")
        .distinct()
    )


def contract(edges: DataFrame) -> DataFrame:
    """``(v, label)`` for every end of an edge; equal label means connected.

    Alternates two star steps until nothing changes. Large star: neighbours above a
    node are hung on the smallest node around it. Small star: neighbours below it are.
    Both aggregate per node and join back, so a hub is pre-aggregated in every task; each
    step is written to the shared checkpoint folder.
    """
    current = materialise(edges.select("a", "b"))
    signature = None
    while True:
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()
        )
        down = large.where("a < b").select(F.col("b").alias("u"), F.col("a").alias("w"))
        root = down.groupBy("u").agg(F.min("w").alias("m"))
        small = (
            down.join(root, "u")
            .select(F.col("m").alias("a"), F.explode(F.array("u", "w")).alias("b"))
            .where("a < b")
            .distinct()
        )
        following = materialise(small)
        release(current)
        current = following
        seen = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(seen) == signature:
            break
        signature = tuple(seen)
    return current.select(F.col("b").alias("v"), F.col("a").alias("label")).unionAll(
        current.select(F.col("a").alias("v"), F.col("a").alias("label")).distinct()
    )


def _components(marked: DataFrame, max_distance: int, id_col: str) -> DataFrame:
    """``__fp``, ``component_id``, ``__label`` (smallest code of the component) per code."""
    codes = materialise(marked.groupBy("__fp").agg(F.min(id_col).alias("__least")))
    labels = contract(links(codes.select("__fp"), max_distance))
    # A code without a link is its own component.
    labelled = codes.join(labels, codes["__fp"] == labels["v"], "left").select(
        codes["__fp"], "__least", F.coalesce("label", codes["__fp"]).alias("__label")
    )
    roots = labelled.groupBy("__label").agg(F.min("__least").alias("component_id"))
    components = materialise(
        labelled.join(roots, "__label").select("__fp", "component_id", "__label")
    )
    release(codes)
    return components


def near_duplicates(
    docs: DataFrame,
    max_distance: int = 3,
    words_per_shingle: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits), ``component_id`` for every row.

    ``component_id`` is the smallest id among all rows reachable over links. Texts
    that are null or have no word share the fingerprint zero and are linked like any
    other. A null id is never the smallest; a component of null ids only has a null
    ``component_id``. Repeated rows stay; other columns are not read. An empty table gives
    no rows.
    """
    marked = materialise(fingerprints(docs, id_col, text_col, words_per_shingle))
    return marked.join(_components(marked, max_distance, id_col), "__fp").select(
        id_col, F.lpad(F.lower(F.hex("__fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame,
    max_distance: int = 3,
    words_per_shingle: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One whole row of each component of near duplicates: one of the smallest id.

    If rows of that id lie in the component with different fingerprints, the smallest
    fingerprint stays; of rows alike in both, a single one. An id whose rows lie in several
    components may stay once in each. A row with a null id stays only if no row of its
    component has an id. All columns are kept. An empty table gives no rows.
    """
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = [fingerprint(text, words_per_shingle) for text in utf8(batch.column(place))]
            column = pa.array(np.array(values, np.uint64).view(np.int64))
            yield batch.append_column("__fp", column)

    # Written beside the rows, so each text is read for its fingerprint once.
    schema = T.StructType([*docs.schema.fields, T.StructField("__fp", T.LongType())])
    rows = materialise(
        docs.mapInArrow(run, schema).withColumn("__row", F.monotonically_increasing_id())
    )
    keys = rows.select(F.col(id_col).alias("__id"), "__fp", "__row")
    components = _components(keys, max_distance, "__id")
    # The row that stays in each component: of the smallest id, then fingerprint.
    first = F.min(F.struct(F.col("__id").isNull(), "__id", "__fp", "__row"))["__row"]
    stays = (
        keys.join(components.select("__fp", "__label"), "__fp")
        .groupBy("__label")
        .agg(first.alias("__stays"))
    )
    kept = rows.join(stays, rows["__row"] == stays["__stays"], "left_semi")
    return kept.select(*docs.columns)
