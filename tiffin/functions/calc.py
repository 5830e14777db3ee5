"""Arithmetic whose result does not depend on row order, so a retried or re-partitioned run gives the same digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Doubles are summed in this type up to LARGE, which keeps 18 decimal places; larger ones are summed as doubles beside it.
FINE = "decimal(38,18)"
LARGE = 1e9


def divide(num: Column, den: Column) -> Column:
    """Double division; NULL for a zero or NULL divisor."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def rounded(c: Column, digits: int) -> Column:
    """Half-up rounding done in decimal: a binary double such as 2.675 sits just below its tie. Values too large for it are
    rounded as doubles."""
    c = c.cast("double")
    return F.coalesce(F.round(c.try_cast(FINE), digits).cast("double"), F.round(c, digits))


def usable(name: str) -> Column:
    """A double that can be summed: NaN and the infinities count as NULL, in sums and in counts alike."""
    c = F.col(name)
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def double_parts(name: str) -> dict[str, Column]:
    """Aggregates from which the sum and the average of a double column follow, at any level: see ``double_sum``."""
    c = usable(name)
    return {
        f"{name}_fine": F.sum(F.when(F.abs(c) < LARGE, c).cast(FINE)),
        f"{name}_large": F.sum(F.when(F.abs(c) >= LARGE, c)),
        f"{name}_n": F.count(c),
    }


def merged_parts(name: str) -> dict[str, Column]:
    """The parts of groups added up."""
    return {f"{name}_{p}": F.sum(f"{name}_{p}") for p in ("fine", "large", "n")}


def double_sum(parts: dict[str, Column]) -> Column:
    """The sum that parts stand for; NULL without a usable value."""
    fine, large, n = parts.values()
    return F.when(n > 0, F.coalesce(fine.cast("double"), F.lit(0.0)) + F.coalesce(large, F.lit(0.0)))


def double_mean(parts: dict[str, Column]) -> Column:
    return divide(double_sum(parts), [*parts.values()][2])


def mean(name: str) -> Column:
    """Average of an integer or decimal column: exact sum over the non-null count."""
    return divide(F.sum(name), F.count(name))


def mean_of_doubles(name: str) -> Column:
    """Average of the usable values of a double column."""
    return double_mean(double_parts(name))


def count_if(cond: Column) -> Column:
    """Number of rows for which the condition is true (NULL counts as false)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def minute_boundaries(start: str, end: str) -> Column:
    """Minute marks crossed between two timestamps: 10:00:50 to 10:02:10 is 2 although 80 seconds passed.

    Taken from the date and clock fields, so the session time zone plays no part.
    """
    a, b = F.col(start), F.col(end)
    days = F.datediff(F.to_date(b), F.to_date(a)).cast("bigint")
    return days * 1440 + (F.hour(b) - F.hour(a)) * 60 + (F.minute(b) - F.minute(a))
