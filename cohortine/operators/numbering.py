"""Dataset-wide running numbers without a one-partition window.

Rows are range-partitioned on their key, sorted and written once. A row's number is then its
index in its file plus the rows of the files before it, both read from the files
themselves, so the written table needs no column for it and is the only copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

_FILE = "__file"
_INDEX = "__index"
_BEFORE = "__before"


def in_order(df: DataFrame, order_by: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """Rows in range partitions of the whole key, sorted, without the columns ``drop``.

    The key must be unique, so that a single hot subject spreads over many partitions.
    """
    return df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).drop(*drop)


def file_offsets(table: DataFrame) -> DataFrame:
    """``file`` and ``before``: how many rows stand in the files before it.

    ``table`` reads Parquet files written in the order of their numbers. One row per file, so
    the window is as small as the number of range partitions.
    """
    # Numbers in a name may grow in width: compared as numbers, not as text.
    part, piece = (
        F.regexp_extract("file", pattern, 1).cast("bigint") for pattern in ("part-([0-9]+)", "-c([0-9]+)[.]")
    )
    earlier = Window.orderBy(part, piece).rowsBetween(Window.unboundedPreceding, -1)
    return (
        table.groupBy(F.col("_metadata.file_name").alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("file", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    )


def numbered(table: DataFrame, name: str, offsets: DataFrame | None = None) -> DataFrame:
    """``table``, read from files written in order, with ``name`` = 1..n.

    ``offsets`` are those of :func:`file_offsets`, where they are already known.
    """
    offsets = file_offsets(table) if offsets is None else offsets
    small = offsets.select(F.col("file").alias(_FILE), F.col("before").alias(_BEFORE))
    return (
        table.select(
            "*", F.col("_metadata.file_name").alias(_FILE), F.col("_metadata.row_index").alias(_INDEX)
        )
        .join(F.broadcast(small), _FILE)
        .withColumn(name, (F.col(_BEFORE) + F.col(_INDEX) + 1).cast("bigint"))
        .drop(_FILE, _INDEX, _BEFORE)
    )


def number_rows(
    df: DataFrame, order_by: Sequence[str], name: str, drop: Sequence[str] = ()
) -> DataFrame:
    """Add ``name`` = 1..n over the whole dataset in ``order_by`` order.

    Equals ``row_number() over (order by ...)``. The rows are written once, without the
    columns ``drop``; :func:`..sinks.files.write_numbered` writes them to their last
    place instead.
    """
    return numbered(materialise(in_order(df, order_by, drop)), name)
