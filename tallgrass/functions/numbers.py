"""Numbers from text, unit repair and data-quality nulling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(text: Column) -> Column:
    """A double from text with thousands separators; blanks and dashes are NULL."""
    return F.regexp_replace(F.trim(text), ",", "").try_cast("double")


def amount(text: Column) -> Column:
    """number() with 0 as NULL."""
    return F.nullif(number(text), F.lit(0.0))


def count(text: Column) -> Column:
    """number() where it is whole, as a long."""
    n = number(text)
    return F.when(n == F.floor(n), n.cast("long"))


def base_price(close: Column, change: Column, largest: float = 0.30) -> Column:
    """The price that the day's change counts from; NULL when not positive or when it implies a larger move."""
    base = close - change
    return F.when((base > 0) & (F.abs(close / base - 1) <= largest), base)


def sane(x: Column, largest: float, sentinel: float = 99.99) -> Column:
    """NULL for the sentinel and for values beyond the limit."""
    return F.when((x != sentinel) & (F.abs(x) <= largest), x)


def repaired_scale(part: Column, whole: Column, units=(1.0, 1e3, 1e6), from_ratio: float = 500.0) -> Column:
    """part in the unit that brings it nearest to whole on a log scale, when they differ by from_ratio or more."""
    ratio = whole / part
    nearest = F.array_min(F.transform(F.array(*map(F.lit, units)), lambda u: F.struct(F.abs(F.ln(ratio / u)).alias("off"), u.alias("unit"))))["unit"]
    return F.when((part > 0) & (whole > 0) & (ratio >= from_ratio), part * nearest).otherwise(part)


def holding_ratio(held: Column, listed: Column) -> Column:
    return F.round(F.try_divide(held, F.nullif(listed, F.lit(0))) * 100, 4)
