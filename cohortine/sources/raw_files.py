"""Raw tables from CSV files, read in parallel with a declared schema.

The header of every file is checked against the schema, and lines that do not fit it are put
aside with their file, never guessed at or dropped silently.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise

_BROKEN = "__broken_line"
_FILE = "__file"


@dataclass(frozen=True)
class RawTable:
    """Lines that fit the schema, and those that do not: ``file``, ``line``."""

    rows: DataFrame
    quarantine: DataFrame


def check_headers(
    spark: SparkSession, path: str, names: list[str], delimiter: str = ",", quote: str = '"'
) -> None:
    """Raise ``ValueError`` unless the first line of every file names the columns in order.

    Reads the first split of every file, and keeps one line of each before anything is shuffled.
    """
    first = (
        spark.read.text(path)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
        .where("at = 0")
        .withColumn("place", F.monotonically_increasing_id())
        # The first line of a file is the first row of the partition that begins the file.
        .groupBy("file")
        .agg(F.min_by("value", "place").alias("header"))
    )
    mark = F.lit("﻿")
    cells = F.split(F.regexp_replace(F.ltrim(F.col("header"), mark), "\r$", ""), f"[{delimiter}]")
    found = F.transform(cells, lambda c: F.btrim(c, F.lit(quote + " ")))
    wrong = first.withColumn("found", found).where(F.col("found") != F.lit(names)).limit(5).collect()
    if wrong:
        told = "; ".join(f"{row['file']}: {', '.join(row['found'])}" for row in wrong)
        raise ValueError(f"header is not {', '.join(names)} in {told}")


def read_raw_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    delimiter: str = ",",
    quote: str = '"',
    multi_line: bool = False,
) -> RawTable:
    """The CSV files of ``path`` under a declared ``schema``, header lines left out.

    A line with too few or too many fields, or a field that is not of its type, goes to the
    quarantine as it is. Empty fields are NULL. Parsed rows are written once, because a line's
    columns and its fault must come from the same pass. ``multi_line`` reads quoted line
    breaks; a file is then one split. An empty folder of files gives no rows.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.names
    check_headers(spark, path, names, delimiter, quote)
    read = T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])
    parsed = (
        spark.read.schema(read)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BROKEN)
        .option("sep", delimiter)
        .option("quote", quote)
        .option("escape", quote)
        .option("multiLine", multi_line)
        .csv(path)
        .withColumn(_FILE, F.col("_metadata.file_path"))
    )
    kept = materialise(parsed)
    fits = F.col(_BROKEN).isNull()
    return RawTable(
        kept.where(fits).select(*names),
        kept.where(~fits).select(F.col(_FILE).alias("file"), F.col(_BROKEN).alias("line")),
    )
