"""Sets of days as one integer per month.

A day set is a table of (key..., month_no, day_mask): bit d-1 of ``day_mask``
is day d. Sets combine with bit operators, ``bit_or`` aggregates them map-side,
and a month of days travels as one row instead of thirty-one. The same way a
year of months is twelve bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ALL_DAYS = (1 << 31) - 1


def month_no(day: Column) -> Column:
    """Months since year 0, an integer that is dense over calendar months."""
    return F.year(day) * 12 + F.month(day) - 1


def month_first(number: Column) -> Column:
    return F.make_date(
        F.floor(number / 12).cast("int"), F.pmod(number, F.lit(12)) + 1, F.lit(1)
    )


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), position)


def day_bit(day: Column) -> Column:
    """Mask with the one bit of this date's day of month."""
    return _bit(F.dayofmonth(day) - 1)


def span_mask(month: Column, start: Column, end: Column) -> Column:
    """Days of ``month`` that lie in the inclusive range start..end."""
    first = month_first(month)
    low = F.greatest(F.datediff(start, first), F.lit(0))
    high = F.least(F.datediff(end, first) + 1, F.dayofmonth(F.last_day(first)))
    return F.when(high > low, _bit(high) - _bit(low)).otherwise(F.lit(0).cast("bigint"))


def month_span_mask(year: Column, start: Column, end: Column) -> Column:
    """Months of ``year`` that the inclusive range start..end touches."""
    low = F.greatest(month_no(start) - year * 12, F.lit(0))
    high = F.least(month_no(end) - year * 12 + 1, F.lit(12))
    return F.when(high > low, _bit(high) - _bit(low)).otherwise(F.lit(0).cast("bigint"))


def month_bit(day: Column) -> Column:
    """Mask with the one bit of this date's month."""
    return _bit(F.month(day) - 1)


def minus(mask: Column, other: Column) -> Column:
    return mask.bitwiseAND(F.bitwise_not(other))


def lowest(mask: Column) -> Column:
    """Day of the lowest bit; of a non-empty mask."""
    return highest(mask.bitwiseAND(-mask))


def highest(mask: Column) -> Column:
    """Day of the highest bit; of a non-empty mask."""
    return F.length(F.bin(mask))


def _once(mask: Column, build: Callable[[Column], Column]) -> Column:
    """The array built of a mask whose expression is not evaluated anew for every use."""
    return F.flatten(F.transform(F.array(mask), build))


def days_in(mask: Column) -> Column:
    """Ascending array of the days of month in the mask.

    Masks of one or two days, the usual case, skip the loop over all days.
    """
    all_days = F.sequence(F.lit(1), F.lit(31))
    several = _once(mask, lambda m: F.filter(all_days, lambda d: F.getbit(m, d - 1) == 1))
    return (
        F.when(F.bit_count(mask) == 1, F.array(highest(mask)))
        .when(F.bit_count(mask) == 2, F.array(lowest(mask), highest(mask)))
        .otherwise(several)
    )


def runs_in(mask: Column) -> Column:
    """Array of (first, last) days of the maximal runs of consecutive days."""

    def runs(m: Column) -> Column:
        return F.zip_with(
            days_in(minus(m, F.shiftleft(m, 1))),
            days_in(minus(m, F.shiftright(m, 1))),
            lambda a, b: F.struct(a.alias("first"), b.alias("last")),
        )

    return _once(mask, runs)


def date_of(month: Column, day: Column) -> Column:
    return F.date_add(month_first(month), day - 1)
