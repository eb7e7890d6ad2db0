"""Column expressions with the exact semantics the reports rely on."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec, functions as F

ALL_MONTHS = (1 << 12) - 1


def series_key(name: Column | str) -> Column:
    """Stable 60-bit key: the first 15 hex digits of the name's SHA-256."""
    digest = F.sha2(F.col(name) if isinstance(name, str) else name, 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def capacity_series_key(name: Column | str) -> Column:
    """The same key in a namespace of its own."""
    column = F.col(name) if isinstance(name, str) else name
    return series_key(F.concat(F.lit("capacity::"), column))


def total_parts(value: Column | str, times: Column | None = None) -> list[Column]:
    """Aggregates: sums of the leading 24 bits of each value and of what is left of it,
    each value as many times as it is said to occur."""
    column = F.col(value) if isinstance(value, str) else value
    lead = F.when(F.abs(column) < F.lit(1e38), column.cast("float").cast("double")).otherwise(column)
    rest = column - lead
    rest = F.when(F.isnan(rest), F.lit(0.0)).otherwise(rest)
    return [F.sum(part if times is None else part * times) for part in (lead, rest)]


def total(value: Column | str, over: WindowSpec | None = None) -> Column:
    """Aggregate: the sum of doubles, in whatever order they come.

    Each value is split into its leading 24 bits and the rest. Sums of the one and of the
    other have bits to spare, so they are exact unless the values of a group differ by
    powers of a thousand, and only their sum is rounded. Beyond the range of the short
    form a value counts whole.
    """
    parts = total_parts(value)
    one, two = parts if over is None else [part.over(over) for part in parts]
    return one + two


def mean(value: Column | str) -> Column:
    """Aggregate: `total` by the number of values."""
    column = F.col(value) if isinstance(value, str) else value
    return total(column) / F.nullif(F.count(column), F.lit(0)).cast("double")


def rounded(value: Column | str, digits: int) -> Column:
    """Rounding for published values: half away from zero, on the double as it is."""
    return F.round(F.col(value) if isinstance(value, str) else value, digits)


def months_mask(month: Column) -> Column:
    """Aggregate: one bit per calendar month seen. Constant-size state that
    combines map-side, in place of COUNT(DISTINCT month)."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1), (month - 1).cast("int")))


def month_count(mask: Column) -> Column:
    return F.bit_count(mask).cast("bigint")


def is_complete(mask: Column) -> Column:
    return mask == F.lit(ALL_MONTHS)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole; null where whole is zero."""
    return F.lit(100.0) * part / F.nullif(whole, F.lit(0.0))


def percent_change(first: Column, latest: Column) -> Column:
    return percent(latest - first, first)


def year_start(year: int) -> Column:
    return F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")


def within_years(date: Column, first: int | None, before: int) -> Column:
    """``first <= year(date) < before`` as a plain range on the date column."""
    upper = date < year_start(before)
    return upper if first is None else (date >= year_start(first)) & upper


def is_missing(column: str, data_type: str) -> Column:
    """Null, or NaN in a floating-point column."""
    value = F.col(column)
    if data_type in ("double", "float"):
        return value.isNull() | F.isnan(value)
    return value.isNull()
