"""Exact interpolated quantiles by repeated narrowing.

``percentile`` keeps every distinct value of a group in one buffer. These
functions instead bracket the wanted order statistic with approximate quantiles,
count both sides, and narrow until the bracket is small enough to look at.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .scans import running_totals, with_blocks

# A bracket with at most this many rows is sorted in one small array.
SMALL_BRACKET = 10_000
_ACCURACY = 1_000


@dataclass
class _Target:
    """Search for the value at one rank, inside the open interval (low, high)."""

    column: str
    rank: int  # zero-based position among the sorted non-null values
    inside: int  # values within the interval
    below: int = 0  # values up to and including ``low``
    low: float | None = None
    high: float | None = None
    answer: float | None = None

    @property
    def interval(self) -> tuple:
        return self.column, self.low, self.high

    def within(self) -> Column:
        x = F.col(self.column).cast("double")
        inside = x.isNotNull()
        if self.low is not None:
            inside = inside & (x > self.low)
        if self.high is not None:
            inside = inside & (x < self.high)
        return F.when(inside, x)


def _propose(df: DataFrame, targets: list[_Target]) -> dict[tuple, tuple[float, float]]:
    """Per interval, a narrower closed bracket from approximate quantiles.

    An approximate quantile is off by at most 1/_ACCURACY of the rows, so going
    twice that far to either side encloses every target of the interval.
    """
    margin = 2 / _ACCURACY
    members: dict[tuple, list[_Target]] = {}
    for t in targets:
        members.setdefault(t.interval, []).append(t)
    aggregates = []
    for k, group in enumerate(members.values()):
        shares = [(t.rank - t.below + 0.5) / t.inside for t in group]
        ends = [max(min(shares) - margin, 0.0), min(max(shares) + margin, 1.0)]
        aggregates.append(
            F.percentile_approx(group[0].within(), ends, _ACCURACY).alias(f"q{k}")
        )
    row = df.agg(*aggregates).first()
    return {key: tuple(row[f"q{k}"]) for k, key in enumerate(members)}


def _narrow(df: DataFrame, targets: list[_Target], brackets: dict[tuple, tuple]) -> None:
    """Count around the proposed brackets, then answer or narrow every target."""
    aggregates = []
    wanted = {t.interval for t in targets}
    brackets = {key: ends for key, ends in brackets.items() if key in wanted}
    for k, ((column, _, _), (low, high)) in enumerate(brackets.items()):
        x = F.col(column).cast("double")
        aggregates += [
            F.count_if(x < low).alias(f"below{k}"),
            F.count_if(x == low).alias(f"low{k}"),
            F.count_if((x > low) & (x < high)).alias(f"inside{k}"),
            F.count_if(x == high).alias(f"high{k}"),
        ]
    row = df.agg(*aggregates).first()
    places = {key: k for k, key in enumerate(brackets)}
    for t in targets:
        k = places[t.interval]
        low, high = brackets[t.interval]
        below = row[f"below{k}"]
        above_low = below + row[f"low{k}"]
        at_high = above_low + row[f"inside{k}"]
        if t.rank < below:
            t.high, t.inside = low, below - t.below
        elif t.rank < above_low:
            t.answer = low
        elif t.rank < at_high:
            t.low, t.high, t.below, t.inside = low, high, above_low, row[f"inside{k}"]
        elif low == high or t.rank < at_high + row[f"high{k}"]:
            t.answer = high
        else:
            past = at_high + row[f"high{k}"]
            t.low, t.inside, t.below = high, t.below + t.inside - past, past


def _read_small(df: DataFrame, targets: list[_Target]) -> None:
    """Pick the answers out of brackets known to hold few rows."""
    places: dict[tuple, int] = {}
    aggregates = []
    for t in targets:
        if t.interval not in places:
            places[t.interval] = len(places)
            values = F.sort_array(F.collect_list(t.within()))
            aggregates.append(values.alias(f"v{places[t.interval]}"))
    row = df.agg(*aggregates).first()
    for t in targets:
        t.answer = row[f"v{places[t.interval]}"][t.rank - t.below]


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probability: float
) -> dict[str, float | None]:
    """Linearly interpolated quantile of each column, NULLs left out."""
    margin = 2 / _ACCURACY
    ends = [max(probability - margin, 0.0), min(probability + margin, 1.0)]
    first = df.agg(
        *[F.count(F.col(c)).alias(f"n_{c}") for c in columns],
        *[
            F.percentile_approx(F.col(c).cast("double"), ends, _ACCURACY).alias(f"q_{c}")
            for c in columns
        ],
    ).first()
    counts = {c: first[f"n_{c}"] for c in columns}
    result: dict[str, float | None] = {}
    targets: dict[tuple[str, int], _Target] = {}
    for column in columns:
        if counts[column] == 0:
            result[column] = None
            continue
        position = (counts[column] - 1) * probability
        for rank in {math.floor(position), math.ceil(position)}:
            targets[column, rank] = _Target(column, rank, inside=counts[column])

    def pending(small: bool) -> list[_Target]:
        return [
            t
            for t in targets.values()
            if t.answer is None and (t.inside <= SMALL_BRACKET) == small
        ]

    brackets = {(c, None, None): tuple(first[f"q_{c}"]) for c in columns if counts[c]}
    while large := pending(small=False):
        _narrow(df, large, brackets)
        large = pending(small=False)
        brackets = _propose(df, large) if large else {}
    if small := pending(small=True):
        _read_small(df, small)

    for column in columns:
        if column in result:
            continue
        position = (counts[column] - 1) * probability
        low, high = math.floor(position), math.ceil(position)
        a, b = targets[column, low].answer, targets[column, high].answer
        result[column] = a + (b - a) * (position - low)
    return result


def grouped_medians(df: DataFrame, group: str, value: str, name: str = "median") -> DataFrame:
    """``group`` and the exact interpolated median of its non-null values.

    Values are counted per (group, value) first; the rank of each value comes from
    running totals over blocks, so no task holds all values of a group. Groups without
    a value are absent.
    """
    counts = materialise(
        df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
        .groupBy(F.col(group).alias("__group"), F.col(value).cast("double").alias("__value"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    ranked = running_totals(with_blocks(counts, "__value"), ["__group"], "__value", {"__upto": "__n"})
    sizes = counts.groupBy("__group").agg(F.sum("__n").alias("__all"))
    upto, low = F.col("__upto"), F.floor((F.col("__all") - 1) / 2)
    high = F.floor(F.col("__all") / 2)

    def at(rank: Column) -> Column:
        return F.min(F.when(upto > rank, F.col("__value")))

    return (
        ranked.join(sizes, "__group")
        .groupBy("__group")
        .agg(((at(low) + at(high)) / 2).alias(name))
        .withColumnRenamed("__group", group)
    )
