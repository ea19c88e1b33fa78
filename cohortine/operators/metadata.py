"""Dataset and variable metadata for a set of tabulation domains."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codelists import DATASET_LABELS, DATASET_STRUCTURES, VARIABLES

_MANDATORY = ("STUDYID", "DOMAIN", "USUBJID")
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)


def _variable_struct(code: str, position: int, field: T.StructField) -> Column:
    label, kind, length = VARIABLES.get(field.name, (field.name, "text", 200))
    if isinstance(field.dataType, _INTEGERS):
        kind = "integer"
    elif isinstance(field.dataType, _FLOATS):
        kind = "float"
    return F.struct(
        F.lit(code).alias("domain"),
        F.lit(position).alias("order_number"),
        F.lit(f"IT.{code}.{field.name}").alias("item_oid"),
        F.lit(field.name).alias("name"),
        F.lit(label).alias("label"),
        F.lit(kind).alias("data_type"),
        F.lit(length).alias("length"),
        F.lit("Yes" if field.name in _MANDATORY else "No").alias("mandatory"),
        F.lit("CRF").alias("origin"),
        F.lit(field.name[:8]).alias("field_name"),
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def variable_metadata(domains: Mapping[str, DataFrame]) -> DataFrame:
    """One row per variable of each domain, with its dataset's record count.

    Numeric types of the data override the listed type. The item identifier holds
    domain and variable name, both unique within the mapping given.
    """
    frames = []
    for code, df in domains.items():
        rows = [_variable_struct(code, i, f) for i, f in enumerate(df.schema.fields, start=1)]
        counted = df.agg(F.count(F.lit(1)).alias("dataset_records"))
        frames.append(counted.select(F.inline(F.array(*rows)), "dataset_records"))
    return _union(frames)


def dataset_metadata(
    domains: Mapping[str, DataFrame], labels: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per domain: label, structure, repeating flag, record count."""
    frames = []
    for code, df in domains.items():
        label = (labels or {}).get(code) or DATASET_LABELS.get(code, code)
        frames.append(
            df.agg(F.count(F.lit(1)).alias("records")).select(
                F.lit(code).alias("domain"),
                F.lit(f"IG.{code}").alias("group_oid"),
                F.lit(label).alias("label"),
                F.lit(DATASET_STRUCTURES.get(code, "One record per subject")).alias("structure"),
                F.lit("Tabulation").alias("purpose"),
                F.lit("No" if code == "DM" else "Yes").alias("repeating"),
                F.lit(len(df.columns)).alias("variables"),
                "records",
            )
        )
    return _union(frames)


def study_summary(
    domains: Mapping[str, DataFrame], study_id: str, standard_version: str = "SDTM 1.7"
) -> DataFrame:
    """Per-domain counts with the number of datasets in the study."""
    datasets = dataset_metadata(domains)
    return datasets.select(
        F.lit(study_id).alias("study_id"),
        F.lit(standard_version).alias("standard_version"),
        "domain",
        "label",
        "records",
        "variables",
        F.lit(len(domains)).alias("total_datasets"),
    )
