"""Running totals over an ordered numeric column, computed block by block.

A plain cumulative window without (or with few) partition keys sends every row to
one task. Here the order column is cut into blocks at approximate quantiles;
each block gets the total of the blocks before it and only sums within itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = "__block"


def with_blocks(df: DataFrame, order_col: str, n_blocks: int | None = None) -> DataFrame:
    """Add a block number that grows with ``order_col``.

    The cut points are at most ``n_blocks`` numbers held by the driver.
    """
    if n_blocks is None:
        n_blocks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    position = df.withColumn("__order", F.col(order_col).cast("double"))
    cuts: list[float] = []
    if n_blocks > 1:
        probabilities = [i / n_blocks for i in range(1, n_blocks)]
        cuts = sorted(set(position.approxQuantile("__order", probabilities, 0.25 / n_blocks)))
    if not cuts:
        return position.withColumn(BLOCK, F.lit(0)).drop("__order")
    splits = [float("-inf"), *cuts, float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol="__order", outputCol="__bucket")
    return (
        bucketizer.transform(position)
        .withColumn(BLOCK, F.col("__bucket").cast("int"))
        .drop("__order", "__bucket")
    )


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order_col: str,
    totals: Mapping[str, str],
    inclusive: bool = True,
    descending: bool = False,
) -> DataFrame:
    """Add running sums; ``totals`` maps each new column to the summed column.

    ``df`` carries the block column from :func:`with_blocks` and at most one row
    per (group, order value). With ``inclusive=False`` the row itself is left out;
    ``descending`` sums from the largest order value down.
    """

    # SQL text keeps plan building cheap: fits call this with dozens of totals.
    way = "DESC" if descending else "ASC"
    last = "CURRENT ROW" if inclusive else "1 PRECEDING"
    keys = ", ".join(f"`{g}`" for g in group)
    by_group = f"PARTITION BY {keys} " if group else ""
    earlier = f"{by_group}ORDER BY {BLOCK} {way} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    within = (
        f"PARTITION BY {keys + ', ' if group else ''}{BLOCK} ORDER BY `{order_col}` {way} "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND {last}"
    )
    # One row per (group, block): at most groups x blocks rows.
    carried = (
        df.groupBy(*group, BLOCK)
        .agg(*[F.sum(source).alias(f"__sum_{name}") for name, source in totals.items()])
        .selectExpr(
            *[f"`{g}`" for g in group],
            BLOCK,
            *[
                f"coalesce(sum(`__sum_{name}`) OVER ({earlier}), 0) AS `__carry_{name}`"
                for name in totals
            ],
        )
    )
    return df.join(carried, [*group, BLOCK]).selectExpr(
        *[f"`{c}`" for c in df.columns],
        *[
            f"`__carry_{name}` + coalesce(sum(`{source}`) OVER ({within}), 0) AS `{name}`"
            for name, source in totals.items()
        ],
    )
