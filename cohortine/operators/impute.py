"""Missing-value imputation by column statistics, plus the audit counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null, numeric_columns
from ..session import materialise, release
from .quantiles import exact_quantiles

STRATEGIES = ("mean", "median", "most_frequent")


def resolve_columns(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    """The requested columns that exist, else every numeric column."""
    return [c for c in columns if c in df.columns] if columns else numeric_columns(df)


def clean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Read NaN as missing in the given columns."""
    return df.withColumns({c: nan_to_null(df, c) for c in columns})


def _modes(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Most frequent value per column, the smallest on ties.

    Values are counted by (column, value) first, so no single aggregation buffer
    holds all distinct values of a column.
    """
    values = F.inline(
        F.array(
            *[
                F.struct(F.lit(i).alias("column"), F.col(c).cast("double").alias("value"))
                for i, c in enumerate(columns)
            ]
        )
    )
    rows = (
        df.select(values)
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("column")
        .agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("mode"))
        .collect()
    )
    found = {columns[row["column"]]: row["mode"] for row in rows}
    return {c: found.get(c) for c in columns}


class SimpleImputer:
    """Fill numeric columns with their mean, median or most frequent value.

    Other columns stay untouched. A column without any value stays NULL.
    """

    def __init__(self, strategy: str = "median", columns: Sequence[str] | None = None):
        if strategy not in STRATEGIES:
            raise ValueError(f"Unknown strategy '{strategy}'. Choose from: {list(STRATEGIES)}")
        self.strategy = strategy
        self.columns = columns
        self.fill: dict[str, float | None] | None = None

    def fit(self, df: DataFrame) -> SimpleImputer:
        columns = resolve_columns(df, self.columns)
        cleaned = clean(df, columns).select(*columns)
        if not columns:
            self.fill = {}
        elif self.strategy == "mean":
            self.fill = cleaned.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()
        elif self.strategy == "median":
            # The search goes through the values several times.
            values = materialise(cleaned)
            self.fill = exact_quantiles(values, columns, 0.5)
            release(values)
        else:
            self.fill = _modes(cleaned, columns)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.fill is None:
            raise RuntimeError("SimpleImputer must be fitted before calling transform().")
        return df.withColumns(
            {
                c: F.coalesce(nan_to_null(df, c).cast("double"), F.lit(value).cast("double"))
                for c, value in self.fill.items()
            }
        )

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


def regression_fill(df: DataFrame, target: str, predictor: str) -> DataFrame:
    """Fill ``target`` from a least-squares line on ``predictor``.

    One round of chained regression with a single predictor: missing predictor
    values count as the predictor's mean, both when fitting and when filling.
    """
    cleaned = clean(df, [target, predictor])
    mean = cleaned.agg(F.avg(predictor)).first()[0]
    x = F.coalesce(F.col(predictor), F.lit(mean).cast("double"))
    row = cleaned.agg(
        F.regr_slope(F.col(target), x).alias("slope"),
        F.regr_intercept(F.col(target), x).alias("intercept"),
    ).first()
    line = F.lit(row["intercept"]).cast("double") + F.lit(row["slope"]).cast("double") * x
    return cleaned.withColumn(target, F.coalesce(F.col(target).cast("double"), line))


def missing_audit(
    before: DataFrame, after: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """Missing values per column before and after imputation."""
    columns = resolve_columns(before, columns)

    def counts(df: DataFrame, name: str) -> DataFrame:
        cleaned = clean(df, columns)
        totals = cleaned.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias(name)) for c in columns]
        return totals.select(F.inline(F.array(*pairs)))

    joined = counts(before, "missing_before").join(counts(after, "missing_after"), "column")
    return joined.withColumn("imputed", F.col("missing_before") - F.col("missing_after"))


def get_imputer(method: str = "mice", **options):
    """Imputer by name: ``simple``, ``mice`` or ``neural``."""
    from .mice import ChainedImputer
    from .neural import NeuralImputer

    methods = {"simple": SimpleImputer, "mice": ChainedImputer, "neural": NeuralImputer}
    if method not in methods:
        raise ValueError(f"Unknown method '{method}'. Choose from: {list(methods)}")
    return methods[method](**options)
