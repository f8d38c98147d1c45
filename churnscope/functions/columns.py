"""Scalar column helpers that pin down the semantics of the original
pandas code (elapsed vs calendar days, NULL instead of NaN, exact money)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_return(invoice: Column | str = "InvoiceNo") -> Column:
    """An invoice number containing ``C`` anywhere (case-sensitive) is a
    return; a null invoice number is not."""
    col = F.col(invoice) if isinstance(invoice, str) else invoice
    return F.coalesce(col.contains("C"), F.lit(False))


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole elapsed days ``end - start``, floored (Timedelta ``.days``).

    23:00 → 09:00 next day is 0, unlike a calendar-day difference."""
    return F.timestamp_diff("DAY", start, end)


def calendar_days(start: Column, end: Column) -> Column:
    """Calendar-date difference (midnights crossed)."""
    return F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")


def micros_between(start: Column, end: Column) -> Column:
    """Exact microseconds ``end - start`` as bigint (for midpoint tests)."""
    return F.timestamp_diff("MICROSECOND", start, end)


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL on a zero denominator (ANSI-safe)."""
    return F.try_divide(num, den)


def to_double(col: Column) -> Column:
    return col.cast("double")


#: Amounts are counted in millionths, the scale of the price type decimal(20,6).
UNITS = 1_000_000
_EXACT = 1 << 53


def units(price: Column, quantity: Column) -> Column:
    """Line amount in integer millionths: exact, and summed per customer as a
    64-bit integer (a decimal sum would run on BigDecimal objects); a sum that
    doesn't fit raises (ANSI)."""
    return (price * F.lit(UNITS)).cast("bigint") * quantity.cast("bigint")


def sum_units(col: str = "Monetary_exact") -> Column:
    """Exact sum of per-customer amounts over any number of customers."""
    return F.sum(F.col(col).cast("decimal(20,0)"))


def money(units_col: Column) -> Column:
    """Integer millionths → currency as the nearest double, identical to
    casting the exact decimal: whole numbers of up to 2^53 are exact doubles
    and one division rounds once; larger ones are divided as decimals."""
    d = units_col.cast("decimal(38,0)")
    exact = F.try_divide(d, F.lit(UNITS).cast("decimal(7,0)")).cast("double")
    return F.when(F.abs(units_col) <= F.lit(_EXACT), units_col.cast("double") / F.lit(float(UNITS))).otherwise(exact)


def round_even(col: Column, digits: int) -> Column:
    """Round half to even like numpy and pandas: ``rint(x·10^d) / 10^d``."""
    scale = float(10 ** digits)
    return F.rint(col.cast("double") * F.lit(scale)) / F.lit(scale)


def true_or_false(cond: Column) -> Column:
    """A comparison that is False (never NULL) when an input is missing —
    pandas compares NaN as False."""
    return F.coalesce(cond, F.lit(False))


def nan_free(col: Column) -> Column:
    """NULL, NaN and ±inf become 0 (pandas fillna(0) then inf→0)."""
    c = col.cast("double")
    return (F.when(c.isNull() | F.isnan(c), F.lit(0.0))
            .when(c.isin(float("inf"), float("-inf")), F.lit(0.0))
            .otherwise(c))
