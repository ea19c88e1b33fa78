"""Shared small tables for the corpus tests."""

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_of(spark, rows):
    """Documents from (id, text) pairs."""
    full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def with_clashes(df):
    """Extra columns whose names operators use themselves."""
    names = ("score", "kept", "held_out", "n_words", "component_id", "sequence_id", "label", "code")
    return df.withColumns({name: F.lit("x") for name in names if name not in df.columns})


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
