"""Protocol metadata from JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT_FIELDS = ("study_title", "protocol_number", "phase", "indication", "sponsor")
ITEM_FIELDS = (
    "primary_endpoints",
    "secondary_endpoints",
    "inclusion_criteria",
    "exclusion_criteria",
)


def _texts(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


PROTOCOL_SCHEMA = T.StructType(
    [
        *_texts(*TEXT_FIELDS),
        *[T.StructField(n, T.ArrayType(T.StringType())) for n in ITEM_FIELDS],
        T.StructField(
            "treatment_arms",
            T.ArrayType(T.StructType(_texts("arm_name", "dose", "route", "frequency"))),
        ),
        T.StructField(
            "visit_schedule",
            T.ArrayType(
                T.StructType(
                    [
                        *_texts("visit_name", "visit_day"),
                        T.StructField("assessments", T.ArrayType(T.StringType())),
                    ]
                )
            ),
        ),
        T.StructField("raw_text_length", T.LongType()),
    ]
)


def _complete(df: DataFrame, document: str | None = None) -> DataFrame:
    """Absent lists become empty; an absent text length is the document's."""
    out = df.withColumns(
        {name: F.coalesce(name, F.array().cast(df.schema[name].dataType)) for name in ITEM_FIELDS}
    )
    if document is None:
        return out
    length = F.coalesce("raw_text_length", F.length(document).cast("bigint"))
    return out.withColumn("raw_text_length", length).drop(document)


def parse_protocols(df: DataFrame, json_col: str) -> DataFrame:
    """Protocol metadata from a JSON text column, one row per document."""
    parsed = df.select(json_col, F.from_json(json_col, PROTOCOL_SCHEMA).alias("__parsed"))
    return _complete(parsed.select(json_col, "__parsed.*"), json_col)


def read_protocols(spark: SparkSession, path: str) -> DataFrame:
    """Protocol metadata from a folder of JSON documents."""
    return _complete(spark.read.schema(PROTOCOL_SCHEMA).option("multiLine", True).json(path))
