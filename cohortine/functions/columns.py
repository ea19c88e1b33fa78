"""Scalar column helpers shared by the domain mappers and derivations.

Everything here is a built-in Spark expression. NaN never leaves these helpers:
Spark orders NaN above every number, so it is turned into NULL on entry.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dates import ORDERS, column_moment

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def require_columns(df: DataFrame, required: Sequence[str], dataset: str) -> None:
    """Raise ``ValueError`` naming the columns that ``df`` lacks."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"{dataset}: missing required columns: {missing}")


def _type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def nan_to_null(df: DataFrame, name: str) -> Column:
    """``df[name]`` with NaN read as missing."""
    if isinstance(_type(df, name), (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(name), F.col(name))
    return F.col(name)


def number_or_null(df: DataFrame, name: str) -> Column:
    """Numeric value of a column; text that is not a number becomes NULL.

    Numeric columns keep their type. Text must be a plain decimal or exponent
    literal: suffixes such as ``5d`` and words such as ``nan`` are not numbers.
    """
    if is_numeric(_type(df, name)):
        return nan_to_null(df, name)
    text = F.col(name).cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def moment_or_null(df: DataFrame, name: str, order: str = ORDERS[0]) -> Column:
    """Timestamp (without zone) of a column; text that is no date becomes NULL.

    A date without a time part is its midnight. ``order`` is that of three numbers in a text,
    as :func:`.dates.settle_orders` finds it.
    """
    return column_moment(df, name, order)


def date_or_null(df: DataFrame, name: str, order: str = ORDERS[0]) -> Column:
    """Date value of a column; text that is no date becomes NULL."""
    return moment_or_null(df, name, order).cast("date")


def iso_date(df: DataFrame, name: str, order: str = ORDERS[0]) -> Column:
    """Date normalised to ``yyyy-MM-dd`` text."""
    return date_or_null(df, name, order).cast("string")


def upper(df: DataFrame, name: str, default: str | None = None) -> Column:
    """Upper-cased text; ``default`` stands in only when the column is absent."""
    if name not in df.columns and default is not None:
        return F.lit(default.upper())
    return F.upper(F.col(name).cast("string"))


def lookup(key: Column, mapping: Mapping[str, str], default: Column | str) -> Column:
    """Code list lookup; a key that is NULL or not listed takes ``default``."""
    keys, values = (F.lit(list(part)) for part in (mapping.keys(), mapping.values()))
    entries = F.map_from_arrays(keys, values)
    fallback = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(F.try_element_at(entries, key), fallback)


def subject_key(study_id: str, site: str = "site_id", subject: str = "subject_id") -> Column:
    """Study-site-subject identifier; NULL when a part is NULL."""
    return F.concat(
        F.lit(f"{study_id}-"), F.col(site).cast("string"), F.lit("-"), F.col(subject).cast("string")
    )


def optional_flag(df: DataFrame, name: str, value: str, when_absent: bool) -> Column:
    """``df[name] = value`` as a non-null condition, or a constant if absent."""
    if name not in df.columns:
        return F.lit(when_absent)
    return F.coalesce(F.col(name) == value, F.lit(False))


def day_diff(end: Column, start: Column) -> Column:
    """Whole days between two dates."""
    return F.datediff(end, start).cast("bigint")


def elapsed_days(end: Column, start: Column) -> Column:
    """Whole elapsed days between two moments, rounded down (not midnights passed).

    Both are read as clock times without a zone, so a change of the clocks in the session's
    zone is no part of the result.
    """
    end, start = end.cast("timestamp_ntz"), start.cast("timestamp_ntz")

    def time_of_day(moment: Column) -> Column:
        return moment - moment.cast("date").cast("timestamp_ntz")

    not_yet = time_of_day(end) < time_of_day(start)
    return (F.datediff(end, start) - F.when(not_yet, 1).otherwise(0)).cast("bigint")


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole``; 0 when there is nothing to divide by."""
    return F.when(whole > 0, 100.0 * part / whole).otherwise(F.lit(0.0))


def fixed_text(value: Column, places: int) -> Column:
    """Fixed-point text of a value rounded half up; NULL stays NULL."""
    text = F.format_string(f"%.{places}f", F.round(value.cast("double"), places))
    return F.when(value.isNotNull(), text)


def count_percent_text(count: Column, whole: Column) -> Column:
    """``n (p%)`` cell text."""
    return F.concat(
        F.coalesce(count, F.lit(0)).cast("string"),
        F.lit(" ("),
        fixed_text(percent(F.coalesce(count, F.lit(0)), whole), 1),
        F.lit("%)"),
    )


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; 0 for blank text."""
    stripped = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(stripped == "", F.lit(0)).otherwise(F.size(F.split(stripped, " ")))


def mean_square(values: Sequence[Column]) -> Column:
    """Row mean of squares over several columns."""
    total = values[0] * values[0]
    for value in values[1:]:
        total = total + value * value
    return total / F.lit(float(len(values)))


def arm_column(df: DataFrame, arm_col: str | None = None) -> str:
    """Treatment column: the given one, else TRTA, else TRT01A."""
    if arm_col is not None:
        return arm_col
    return "TRTA" if "TRTA" in df.columns else "TRT01A"


def arm_values(df: DataFrame, arm_col: str) -> list[str]:
    """Sorted distinct arms, used as report columns.

    Like ``pivot`` itself this refuses more values than
    ``spark.sql.pivotMaxValues``, because each arm becomes a column.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    rows = df.select(arm_col).where(F.col(arm_col).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{arm_col} has more than {limit} values; pass the arms to report")
    return sorted(row[0] for row in rows)
