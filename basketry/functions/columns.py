"""Column expressions shared by the operators. All stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Float sums differ in their last bits with the order of addition. Rankings look at
# amounts rounded to this many places, far below a cent; thresholds, which are met
# by every row, allow for half a unit there instead, which costs no rounding.
NOISE_PLACES = 6
FLOAT_NOISE = 0.5 * 10**-NOISE_PLACES


def as_day(moment: Column) -> Column:
    return F.to_date(moment)


def month_start(moment: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(F.to_date(moment), "MM")


def days_between(later: Column, earlier: Column) -> Column:
    """Calendar days between two moments; NULL when either is missing."""
    return F.datediff(F.to_date(later), F.to_date(earlier)).cast("long")


def month_boundaries(later: Column, earlier: Column) -> Column:
    """Number of month boundaries crossed between two dates."""
    years = F.year(later) - F.year(earlier)
    return (years * 12 + F.month(later) - F.month(earlier)).cast("long")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, NULL for a zero or missing denominator."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column, places: int | None = None) -> Column:
    value = ratio(part, whole) * 100
    return value if places is None else F.round(value, places)


def denoised(amount: Column) -> Column:
    return F.round(amount, NOISE_PLACES)


def first_match(rules: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """Label of the first rule that holds."""
    (condition, label), *rest = rules
    chain = F.when(condition, F.lit(label))
    for condition, label in rest:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def count_true(flag: Column) -> Column:
    """Rows for which the flag is true: 0, not NULL, when there are none."""
    return F.count_if(flag)


def without_nan(value: Column) -> Column:
    """A double with NaN turned into NULL, so that it counts as missing."""
    return F.when(~F.isnan(value), value)
