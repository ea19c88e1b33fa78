"""Writers for datasets, reports and metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import file_offsets, in_order, numbered
from ..operators.tables import Report


def write_dataset(
    df: DataFrame, code: str, folder: str, partition_by: Sequence[str] = ()
) -> str:
    """Write a domain as Parquet under its lower-cased code; returns the path."""
    path = f"{folder.rstrip('/')}/{code.lower()}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_numbered(
    df: DataFrame, code: str, folder: str, order_by: Sequence[str], drop: Sequence[str] = ()
) -> str:
    """Write a domain as Parquet in the order of its sequence numbers; returns the path.

    The data files are the only copy of the rows. A manifest beside them, ``<path>_offsets``, has
    one row per file: its name and the rows before it.
    """
    path = f"{folder.rstrip('/')}/{code.lower()}"
    in_order(df, order_by, drop).write.mode("overwrite").parquet(path)
    spark = df.sparkSession
    offsets = file_offsets(spark.read.parquet(path))
    offsets.coalesce(1).write.mode("overwrite").parquet(f"{path}_offsets")
    return path


def read_numbered(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A dataset of :func:`write_numbered` with its sequence variable ``name``."""
    offsets = spark.read.parquet(f"{path}_offsets")
    return numbered(spark.read.parquet(path), name, offsets)


def write_report(report: Report, folder: str) -> str:
    """Write a report as CSV, named after its number; returns the path.

    Part files are in print order. The print-order columns of tables are dropped.
    """
    path = f"{folder.rstrip('/')}/table_{report.number.replace('.', '_')}"
    body = report.body.orderBy(*report.order_by) if report.order_by else report.body
    body = body.drop(*[c for c in report.order_by if c in ("block", "row")])
    body.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_mapping(mapping: DataFrame, path: str) -> None:
    """Write an endpoint mapping as CSV; ``endpoint`` is the first column."""
    mapping.write.mode("overwrite").option("header", True).csv(path)


def write_define(variables: DataFrame, datasets: DataFrame, folder: str) -> tuple[str, str]:
    """Write variable and dataset metadata as XML elements; returns both paths."""
    root = folder.rstrip("/")
    label = F.struct(F.col("label").alias("TranslatedText")).alias("Description")
    items = variables.select(
        F.col("item_oid").alias("_OID"),
        F.col("name").alias("_Name"),
        F.col("data_type").alias("_DataType"),
        F.col("length").alias("_Length"),
        F.col("field_name").alias("_SASFieldName"),
        F.col("origin").alias("_Origin"),
        label,
    )
    # A domain has a few dozen variables, so the lists below are small.
    references = variables.groupBy("domain").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col("order_number").alias("_OrderNumber"),
                    F.col("item_oid").alias("_ItemOID"),
                    F.col("mandatory").alias("_Mandatory"),
                )
            )
        ).alias("ItemRef")
    )
    groups = datasets.join(references, "domain", "left").select(
        F.col("group_oid").alias("_OID"),
        F.col("domain").alias("_Name"),
        F.col("repeating").alias("_Repeating"),
        F.lit("No").alias("_IsReferenceData"),
        F.col("domain").alias("_SASDatasetName"),
        F.col("structure").alias("_Structure"),
        F.col("purpose").alias("_Purpose"),
        F.col("records").alias("_Records"),
        label,
        "ItemRef",
    )
    paths = f"{root}/item_defs", f"{root}/item_group_defs"
    for frame, tag, path in ((items, "ItemDef", paths[0]), (groups, "ItemGroupDef", paths[1])):
        frame.write.mode("overwrite").format("xml").option("rootTag", f"{tag}s").option(
            "rowTag", tag
        ).save(path)
    return paths
