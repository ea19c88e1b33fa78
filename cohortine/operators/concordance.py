"""Exact concordance index without comparing pairs one by one.

A pair is comparable when the first subject had the event and the second was
still under observation: it left later, or was censored at the same time. It is
concordant when the first has the higher risk score.

Time and score are cut into blocks at approximate quantiles, which lays a grid over the rows.
A concordant partner of an event lies

* in a later time block and a lower score block: counted from the sums of the grid's cells,
* in the same time block: the rows of a time block are counted in one task,
* in a later time block and the same score block: likewise by score block.

So each row is shuffled twice, however many there are. A cut value is a block of its own;
a hot time or score, which is always one, therefore never makes a large task: one score has no
lower one, and rows of one time are counted by running totals over the score.
"""

from __future__ import annotations

from operator import mul

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise, release
from .scans import BLOCK, running_totals

_WIDE = "decimal(38,0)"
#: Cuts of time or score at most.
MOST_CUTS = 512


def _pairs(
    kind: str, rows: DataFrame, group: list[str], event: str, later: str, censored: str
) -> DataFrame:
    """Sum over events of the rows that leave after them, within each group."""
    totals = running_totals(
        rows, group, "time", {"after": later}, inclusive=False, descending=True
    )
    partners = F.col("after") + F.col(censored)
    pairs = F.sum(F.col(event).cast(_WIDE) * partners.cast(_WIDE))
    return totals.agg(F.coalesce(pairs, F.lit(0)).cast("bigint").alias("pairs")).select(
        F.lit(kind).alias("kind"), "pairs"
    )


def _blocks(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add a block number that grows with ``value``; each cut value is a block of its own."""
    conf = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    n = max(2, min(int(conf), MOST_CUTS))
    position = df.withColumn("__order", F.col(value).cast("double"))
    probabilities = [i / n for i in range(1, n)]
    cuts = sorted(set(position.approxQuantile("__order", probabilities, 0.25 / n)))
    if not cuts:
        return position.withColumn(name, F.lit(1)).drop("__order")
    splits = [float("-inf"), *cuts, float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol="__order", outputCol="__bucket")
    bucket = F.col("__bucket").cast("int")
    above = F.coalesce(F.col("__order") != F.get(F.lit(cuts), bucket - 1), F.lit(True))
    numbered = bucketizer.transform(position).withColumn(name, 2 * bucket + above.cast("int"))
    return numbered.drop("__order", "__bucket")


def count_below(
    order: np.ndarray, score: np.ndarray, weight: np.ndarray, events: np.ndarray
) -> int:
    """Sum over points of their events times the weights before them at a lower score.

    Points come in the order of ``order``. Two different ranks first differ at one binary
    digit, so each pair is met at one digit: where the higher digits agree, points with digit
    1 meet those with digit 0 before them.
    """
    place = np.argsort(order, kind="stable")
    rank = np.unique(score, return_inverse=True)[1][place]
    weight, events = weight[place], events[place]
    total = 0
    for digit in range(int(rank.max(initial=0)).bit_length()):
        by_prefix = np.argsort(rank >> (digit + 1), kind="stable")
        prefix = (rank >> (digit + 1))[by_prefix]
        high = ((rank >> digit) & 1)[by_prefix] == 1
        low_weight = np.where(high, 0, weight[by_prefix])
        upto = np.cumsum(low_weight)
        first = np.append(True, prefix[1:] != prefix[:-1])
        begin = np.maximum.accumulate(np.where(first, np.arange(len(prefix)), 0))
        below = upto - (upto - low_weight)[begin]
        met = high & (events[by_prefix] > 0) & (below > 0)
        # Products of counts may pass 64 bits: plain integers.
        total += sum(map(mul, events[by_prefix][met].tolist(), below[met].tolist()))
    return total


def _within(rows: DataFrame, block: str, by_time: bool) -> DataFrame:
    """Pairs inside the blocks of one kind, one number (as text) per block."""

    def count(batch: pd.DataFrame) -> pd.DataFrame:
        moment = -(batch["time"] if by_time else batch["tb"]).to_numpy(dtype=float)
        rank = np.unique(moment, return_inverse=True)[1]
        score, event, censored = (batch[c].to_numpy() for c in ("score", "n_event", "n_censored"))
        none = np.zeros_like(event)
        if by_time:
            # At one time: the censored count as later, the events do not.
            order = np.concatenate([3 * rank, 3 * rank + 1, 3 * rank + 2])
            weight, events = np.concatenate([censored, none, event]), np.concatenate([none, event, none])
        else:
            order = np.concatenate([2 * rank, 2 * rank + 1])
            weight, events = np.concatenate([none, event + censored]), np.concatenate([event, none])
        times = len(order) // len(rank)
        pairs = count_below(order, np.tile(score, times), weight, events)
        return pd.DataFrame({"pairs": [str(pairs)]})

    columns = ("tb", "sb", "time", "score", "n_event", "n_censored")
    return rows.select(*columns).groupBy(block).applyInPandas(count, "pairs string")


def _concordant(rows: DataFrame) -> int:
    """Concordant pairs of the rows laid over the grid of ``tb`` and ``sb``."""
    cells = (
        rows.groupBy("tb", "sb")
        .agg(F.sum("n_event").alias("event"), F.sum("n_all").alias("n"))
        .toArrow()  # at most (2 * MOST_CUTS) ** 2 cells
    )
    total = 0
    if cells.num_rows:
        tb, sb, event, n = (cells[c].to_numpy() for c in ("tb", "sb", "event", "n"))
        grid = np.zeros((tb.max() + 2, sb.max() + 2), np.int64)
        grid[tb, sb + 1] = n
        # Cells later in time (below in the grid) and lower in score (to the left).
        later = grid[::-1].cumsum(axis=0)[::-1].cumsum(axis=1)[tb + 1, sb]
        total += sum(map(mul, event.tolist(), later.tolist()))
    # A block of one value holds a single score, or a single time.
    flat_time, flat_score = F.col("tb") % 2 == 0, F.col("sb") % 2 == 0
    counted = [
        _within(rows.where(~flat_time), "tb", True),
        _within(rows.where(~flat_score), "sb", False),
    ]
    one_time = rows.where(flat_time).withColumnRenamed("sb", BLOCK)
    sums = running_totals(one_time, ["tb"], "score", {"below": "n_censored"}, inclusive=False)
    product = F.col("n_event").cast(_WIDE) * F.col("below").cast(_WIDE)
    counted.append(sums.agg(F.sum(product).cast("string").alias("pairs")))
    for part in counted:
        summed = part.agg(F.sum(F.col("pairs").cast(_WIDE))).first()[0]
        total += int(summed or 0)
    return total


def concordance(
    df: DataFrame, score: str, duration: str = "AVAL", censor: str = "CNSR"
) -> DataFrame:
    """One row: comparable, concordant and tied pairs, and the index.

    A higher ``score`` means a higher risk. A tie in score counts one half.
    """
    complete = df.select(
        F.col(duration).alias("time"), F.col(censor).alias("censor"), F.col(score).alias("score")
    ).na.drop()
    counts = materialise(
        complete.groupBy("score", "time").agg(
            F.count_if(F.col("censor") == 0).alias("n_event"),
            F.count_if(F.col("censor") != 0).alias("n_censored"),
        )
    )
    rows = materialise(
        _blocks(_blocks(counts, "time", "tb"), "score", "sb").withColumn(
            "n_all", F.col("n_event") + F.col("n_censored")
        )
    )
    by_time = rows.groupBy(F.col("tb").alias(BLOCK), "time").agg(
        F.sum("n_event").alias("n_event"),
        F.sum("n_censored").alias("n_censored"),
        F.sum("n_all").alias("n_all"),
    )
    comparable = _pairs("comparable", by_time, [], "n_event", "n_all", "n_censored")
    by_score = rows.withColumnRenamed("tb", BLOCK)
    tied = _pairs("tied", by_score, ["score"], "n_event", "n_all", "n_censored")
    concordant = df.sparkSession.createDataFrame(
        [("concordant", _concordant(rows))], "kind string, pairs bigint"
    )
    kinds = ("comparable", "concordant", "tied")
    total = comparable.unionByName(concordant).unionByName(tied).agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("pairs"))).alias(k) for k in kinds]
    )
    return total.withColumn(
        "concordance",
        F.when(
            F.col("comparable") > 0,
            (F.col("concordant") + 0.5 * F.col("tied")) / F.col("comparable"),
        ),
    )
