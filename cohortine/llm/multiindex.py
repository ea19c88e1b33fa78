"""Exact top-k search over binary codes by incremental multi-index hashing.

A code of 64 bits is cut into segments of about log2(n) bits. A query looks up, segment
by segment, the codes whose segment differs by exactly ``r`` bits from its own, for
r = 0, 1, 2 ... A code not seen when all segments are done up to radius ``r`` differs by
at least ``r + 1`` in every segment, so in ``segments * (r + 1)`` bits in total; with the
first ``a`` segments also done at ``r + 1``, in ``a`` bits more. A query stops as soon as
its k-th verified distance lies below that bound, which proves the result complete, ties
included.

Equal codes are one entry of the index that keeps its ``k`` smallest ids: no further
row of that code can be among the k nearest of any query. Equal queries search once.
"""

from __future__ import annotations

from itertools import combinations
from math import log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise, release

BITS = 64


def sign_code(vector: str) -> Column:
    """64-bit code of a float array: bit i (from the top) is set if element i is over 0.

    Elements after the 64th are folded on by exclusive or; null and NaN count as 0.
    """
    bits = (
        f"transform({vector}, (x, i) -> if(coalesce(x > 0 and not isnan(x), false), "
        f"shiftleft(1L, {BITS - 1} - i % {BITS}), 0L))"
    )
    return F.expr(f"coalesce(aggregate({bits}, 0L, (a, b) -> a ^ b), 0L)")


def segment_widths(n_codes: int) -> list[int]:
    """Widths of the segments for an index of so many codes: near log2 of it each."""
    count = max(1, min(BITS, int(BITS // max(1.0, log2(max(n_codes, 2))))))
    return [BITS // count + (i < BITS % count) for i in range(count)]


def _segments(code: Column, widths: list[int]) -> Column:
    parts, low = [], BITS
    for i, width in enumerate(widths):
        low -= width
        mask = F.lit((1 << width) - 1 if width < 64 else -1).cast("bigint")
        value = F.shiftrightunsigned(code, low).bitwiseAND(mask)
        parts.append(F.struct(F.lit(i).alias("seg"), value.alias("v")))
    return F.explode(F.array(*parts))


def _flips(width: int, radius: int) -> Column:
    values = [sum(1 << b for b in bits) for bits in combinations(range(width), radius)]
    return F.from_json(F.lit(str(values)), "array<bigint>")


def top_k(
    codes: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    code_col: str = "code",
) -> DataFrame:
    """The ``k`` nearest rows of ``codes`` for every row of ``queries``.

    Both have an id and a ``bigint`` code. Returns ``query_id``, ``rank`` (from 1),
    ``neighbour_id``, ``distance``; nearer first, the smaller id on a tie. Rows with a
    null id or code are left out. Repeated (id, code) rows of the index count once;
    repeated queries give one answer. With fewer than ``k`` rows all of them are
    returned. An empty side gives no rows.
    """
    by_id = Window.partitionBy("code").orderBy("id")
    kept = (
        codes.select(F.col(code_col).cast("bigint").alias("code"), F.col(id_col).alias("id"))
        .dropna()
        .distinct()
        .withColumn("place", F.row_number().over(by_id))
        .where(F.col("place") <= k)
    )
    members = materialise(kept.select("code", "id"))
    # A code stands for its smallest id: the k best codes by (distance, least id) hold the
    # k best rows, so no more than k codes are ever kept for a query.
    distinct = materialise(members.groupBy("code").agg(F.min("id").alias("least")))
    asked = materialise(
        queries.select(F.col(code_col).cast("bigint").alias("q"), F.col(id_col).alias("query_id"))
        .dropna()
        .distinct()
    )
    n = distinct.count()
    widths = segment_widths(n)
    m = len(widths)
    index = materialise(
        distinct.select("code", "least", _segments(F.col("code"), widths).alias("s")).select(
            "code", "least", "s.seg", "s.v"
        )
    )

    # What each distinct query code knows: its best codes so far, and how far it must look.
    # ``reach`` is the number of leading segments to probe at this radius.
    todo = asked.select("q").distinct().select("q", F.lit(m).alias("reach"), F.lit(BITS).alias("kth"))
    found: DataFrame | None = None
    todo = materialise(todo)
    for radius in range(max(widths) + 1):
        probes = (
            todo.select("q", "reach", "kth", _segments(F.col("q"), widths).alias("s"))
            .where(F.col("s.seg") < F.col("reach"))
            .select("q", "kth", "s.seg", "s.v")
        )
        flips = F.array(*[_flips(width, radius) for width in widths])
        probes = probes.select(
            "q", "kth", "seg", "v", F.explode(F.get(flips, F.col("seg"))).alias("flip")
        ).select("q", "kth", "seg", F.col("v").bitwiseXOR(F.col("flip")).alias("v"))
        apart = F.col("q").bitwiseXOR(F.col("code"))
        # A pair is taken where it is met first: no segment before this one is as near,
        # none after it is nearer.
        low, new = BITS, F.lit(True)
        for i, width in enumerate(widths):
            low -= width
            mask = F.lit((1 << width) - 1 if width < 64 else -1).cast("bigint")
            differ = F.bit_count(F.shiftrightunsigned(apart, low).bitwiseAND(mask))
            new = new & (differ >= F.when(F.col("i.seg") > i, radius + 1).otherwise(radius))
        hits = (
            # The probes are many times larger than the planner can know: never broadcast.
            probes.hint("merge")
            .alias("p")
            .join(
                index.alias("i"),
                (F.col("p.seg") == F.col("i.seg"))
                & (F.col("p.v") == F.col("i.v"))
                & (F.bit_count(apart) <= F.col("kth"))
                & new,
            )
            .select("q", "code", "least", F.bit_count(apart).alias("distance"))
        )
        everything = hits if found is None else found.drop("is_kth").unionAll(hits)
        nearest = Window.partitionBy("q").orderBy("distance", "least")
        best = materialise(
            everything.withColumn("place", F.row_number().over(nearest))
            .where(F.col("place") <= k)
            .select("q", "code", "least", "distance", (F.col("place") == k).alias("is_kth"))
        )
        if found is not None:
            release(found)
        found = best
        kth = found.where("is_kth").select("q", F.col("distance").alias("known"))
        # Unseen codes are at least m * (radius + 1) away; each further segment adds one.
        left = (
            todo.join(kth, "q", "left")
            .select("q", F.coalesce("known", F.lit(BITS)).alias("kth"), "known")
            .withColumn(
                "reach",
                F.when(F.col("known").isNull(), m).otherwise(
                    F.least(F.lit(m), F.col("known") - m * (radius + 1) + 1)
                ),
            )
            .where(F.col("reach") > 0)
            .select("q", "reach", "kth")
        )
        left = materialise(left)
        release(todo)
        todo = left
        if todo.isEmpty():
            break
    release(todo, index, distinct)
    rows = found.join(members, "code").select(
        "q", "distance", F.col("id").alias("neighbour_id")
    )
    per_code = Window.partitionBy("q").orderBy("distance", "neighbour_id")
    rows = rows.withColumn("rank", F.row_number().over(per_code)).where(F.col("rank") <= k)
    return asked.join(rows, "q").select("query_id", "rank", "neighbour_id", "distance")
