"""Dates as people and capture systems write them, read column by column.

A text is cut into its parts by one regular expression per way of writing. Three numbers
such as ``05/01/2024`` do not say which is the day. One pass over the column finds the
orders that every such value fits, a bit mask per value, and that settles the order for all.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Orders of three numbers, the preferred first; the place in this list is the bit.
ORDERS = ("MDY", "DMY", "YMD")
#: Two-digit years up to this one are 20xx, others 19xx.
LAST_SHORT_YEAR = 68

_MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"
_MONTH = (
    "JAN(?:UARY)?|FEB(?:RUARY)?|MAR(?:CH)?|APR(?:IL)?|MAY|JUNE?|JULY?|AUG(?:UST)?|"
    "SEPT?(?:EMBER)?|OCT(?:OBER)?|NOV(?:EMBER)?|DEC(?:EMBER)?"
)
_WEEKDAY = r"(?:(?:MON|TUES?|WED(?:NES)?|THU(?:RS?)?|FRI|SAT(?:UR)?|SUN)(?:DAY)?\.?,?\s+)?"
_ZONE = r"(?:Z|UTC|GMT|(?:GMT|UTC)?[+-]\d{2}(?::?\d{2})?)?"
_TIME = rf"(?:T|:|,?\s+)(\d{{1,2}}):(\d{{2}})(?::(\d{{2}}(?:[.,]\d+)?))?\s*([AP]M)?\s*{_ZONE}$"
_NTH = "(?:ST|ND|RD|TH)?"
#: The usual way, a whole date in ISO form and nothing else, which needs no parts.
_ISO = r"^\d{4}-\d{2}-\d{2}\z"


def _written(date: str, kind: str, year: int, month: int, day: int, groups: int) -> tuple[str, str]:
    """A whole pattern, and its parts: kind, year, month, day, hour, minute, second, half."""
    # A leading zero, so that no part to be cast is empty: a failed cast costs an exception.
    time = [f"0${groups + i}" for i in (1, 2, 3)]
    parts = [kind, *[f"${i}" for i in (year, month, day)], *time, f"${groups + 4}"]
    return f"^{date}(?:{_TIME}|$)", "|".join(parts)


#: Ways of writing a date; three numbers (kind T) as first, second and third.
_WAYS = (
    _written(r"(\d{4})([-/.])(\d{1,2})\2(\d{1,2})", "P", 1, 3, 4, 4),
    _written(r"(\d{1,2})([-/.])(\d{1,2})\2(\d{4}|\d{2})", "T", 1, 3, 4, 4),
    _written(
        rf"{_WEEKDAY}(\d{{1,2}}){_NTH}[\s./-]*({_MONTH})\.?[\s.,/-]*(\d{{4}}|\d{{2}})", "P", 3, 2, 1, 3
    ),
    _written(
        rf"{_WEEKDAY}({_MONTH})\.?[\s-]*(\d{{1,2}}){_NTH}(?:,\s*|[\s-]+)(\d{{4}}|\d{{2}})",
        "P", 3, 1, 2, 3,
    ),
    _written(r"(\d{4})(\d{2})(\d{2})", "P", 1, 2, 3, 3),
    _written(rf"(\d{{4}})[\s./-]({_MONTH})[\s./-](\d{{1,2}})", "P", 1, 2, 3, 3),
)
#: Year, month and day of three numbers.
_PLACES = {"MDY": (3, 1, 2), "DMY": (3, 2, 1), "YMD": (1, 2, 3)}


@dataclass(frozen=True)
class DateOrder:
    """What one pass over a text column says about its three-number dates.

    ``settled``: exactly one order fits all of them (or there are none). Otherwise
    ``order`` is the preferred one of those that fit all, or the one that fits most.
    ``open_values`` are dates that fit several orders, ``against`` those that do not fit
    ``order`` and are read by an order that they fit, ``unread`` texts that are no date.
    """

    order: str = ORDERS[0]
    settled: bool = True
    open_values: int = 0
    against: int = 0
    unread: int = 0


def _parts(name: str) -> Column:
    """The parts of a text column's dates; null where it is no date."""
    text = F.upper(F.trim(F.col(name).cast("string")))
    found = F
    for pattern, parts in _WAYS:
        found = found.when(text.rlike(pattern), F.regexp_replace(text, pattern, parts))
    return F.split(found, r"\|")


def _iso_date(name: str) -> Column:
    """The date of a text in plain ISO form; null for any other and for days that do not exist."""
    text = F.col(name).cast("string")
    return F.when((F.length(text) == 10) & text.rlike(_ISO), text.try_cast("date"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _is_triple(parts: Column) -> Column:
    return parts[0] == "T"


def _fits(parts: Column, order: str) -> Column:
    year, month, day = (parts[i] for i in _PLACES[order])
    fits = month.try_cast("int").between(1, 12) & day.try_cast("int").between(1, 31)
    return fits & (F.length(parts[3]) == 2) if order == "YMD" else fits


def _mask(parts: Column) -> Column:
    """Bit mask of the orders that three numbers fit; 0 for any other date."""
    bits = [F.when(_fits(parts, order), 1 << i).otherwise(0) for i, order in enumerate(ORDERS)]
    return F.when(_is_triple(parts), bits[0] + bits[1] + bits[2]).otherwise(0)


def _moment(parts: Column, order: str) -> Column:
    date = F.when(~_is_triple(parts), F.slice(parts, 2, 3))
    for way in [order, *[other for other in ORDERS if other != order]]:
        date = date.when(_fits(parts, way), F.array(*[parts[i] for i in _PLACES[way]]))
    hour, half = parts[4].try_cast("int"), parts[7]
    noon = F.when(half == "PM", 12).otherwise(0)
    hour = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + noon)
    minute = parts[5].try_cast("int")
    second = F.translate(parts[6], ",", ".").try_cast("decimal(16,6)")

    def at(date: Column) -> Column:
        number = date[0].try_cast("int")
        century = F.when(number <= LAST_SHORT_YEAR, 2000).otherwise(1900)
        year = number + F.when(F.length(date[0]) == 2, century).otherwise(0)
        named = F.instr(F.lit(_MONTHS), F.substring(date[1], 1, 3))
        month = F.when(named > 0, ((named + 2) / 3).cast("int")).otherwise(date[1].try_cast("int"))
        return F.try_make_timestamp_ntz(year, month, date[2].try_cast("int"), hour, minute, second)

    return _let(date, at)


def read_moment(name: str, order: str = ORDERS[0]) -> Column:
    """Timestamp without zone of a text column; null if it is no date.

    Date and time of day are taken as written: a zone or an offset is accepted and left out.
    Without a time the moment is midnight. Three numbers are read in ``order`` or, if they do
    not fit it, in one that they fit.
    """
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}")
    # Of a plain ISO date that does not exist the parts give null as well.
    taken = _let(_parts(name), lambda parts: _moment(parts, order))
    return F.coalesce(_iso_date(name).cast("timestamp_ntz"), taken)


def column_moment(df: DataFrame, name: str, order: str = ORDERS[0]) -> Column:
    """:func:`read_moment` of a text column, or the value of a typed one without its zone."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("timestamp_ntz")
    return read_moment(name, order)


def settle_orders(df: DataFrame, names: Sequence[str]) -> dict[str, DateOrder]:
    """The order of day, month and year in every text column of ``names``.

    One pass over those columns, in which equal texts are counted and then read once; a handful
    of rows reach the driver. Columns that are no text, or
    that ``df`` does not have, are left out.
    """
    texts = [n for n in names if n in df.columns and isinstance(df.schema[n].dataType, T.StringType)]
    if not texts:
        return {}
    def code(name: str) -> Column:
        """The mask of a value, 0 for another date or none, -1 for a text that is no date."""
        found = _let(
            _parts(name), lambda parts: F.when(_moment(parts, ORDERS[0]).isNotNull(), _mask(parts))
        )
        empty = F.coalesce(F.trim(name) == "", F.lit(True))
        plain = F.when(_iso_date(name).isNotNull(), 0)
        return F.coalesce(plain, found, F.when(empty, 0).otherwise(-1))

    # A handful of rows per column: how many values have which mask.
    values = df.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("text")) for n in texts]))
    )
    codes = values.groupBy("name", "text").agg(F.count(F.lit(1)).alias("n")).select(
        "name", code("text").alias("code"), "n"
    )
    counts: dict[str, dict[int, int]] = {name: {} for name in texts}
    for name, value, n in codes.groupBy("name", "code").agg(F.sum("n")).collect():
        counts[name][value] = n
    return {name: _settled(counts[name]) for name in texts}


def _settled(counts: dict[int, int]) -> DateOrder:
    masks = {mask: n for mask, n in counts.items() if mask > 0}
    unread = counts.get(-1, 0)
    if not masks:
        return DateOrder(unread=unread)
    common = reduce(and_, masks)
    fitting = {o: sum(n for m, n in masks.items() if m >> i & 1) for i, o in enumerate(ORDERS)}
    # With no order for all values, the one for most of them; the first on a tie.
    left = [o for i, o in enumerate(ORDERS) if common >> i & 1]
    order = left[0] if left else max(ORDERS, key=fitting.get)
    several = sum(n for mask, n in masks.items() if mask.bit_count() > 1)
    return DateOrder(order, len(left) == 1, several, sum(masks.values()) - fitting[order], unread)
