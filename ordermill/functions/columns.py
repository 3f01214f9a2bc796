"""Column expressions shared by all layers. Everything stays a built-in JVM expression.

Casts never raise: a malformed value becomes NULL, whatever the ANSI setting of the session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lower_text(name: str) -> Column:
    return F.trim(F.lower(F.col(name)))


def upper_text(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def whole(name: str) -> Column:
    return F.col(name).try_cast("int")


def real(name: str) -> Column:
    return F.col(name).try_cast("double")


def moment(df: DataFrame, name: str) -> Column:
    """Parse text to a timestamp; a column that already is one passes through unchanged."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(F.col(name))
    return F.col(name)


def days_between(end: str, start: str) -> Column:
    """Calendar days from ``start`` to ``end`` (23:59 to 00:01 the next day is 1)."""
    return F.datediff(F.col(end), F.col(start))


def fractional_days(end: str, start: str) -> Column:
    micros = F.unix_micros(F.col(end).cast("timestamp")) - F.unix_micros(F.col(start).cast("timestamp"))
    return micros / F.lit(86_400_000_000.0)


def month_of(name: str) -> Column:
    """Start of the month, as a timestamp that no session time zone can shift."""
    return F.trunc(F.col(name).cast("date"), "month").cast("timestamp_ntz")



def late_or_not(delay: str) -> Column:
    """Cleaned-orders flag: 1 when late, otherwise 0; an unknown outcome counts as 0."""
    return F.when(F.col(delay) > 0, 1).otherwise(0)


def late_if_known(delay: str) -> Column:
    """Star-schema flag: 1 late, 0 on time, NULL while the outcome is unknown."""
    return (F.col(delay) > 0).cast("int")


def amount(name: str) -> Column:
    """Money as an exact decimal, so that sums don't depend on row order and are rounded only once.

    NULL for what is no amount: NaN, an infinity, or 10^14 and more (see the ``unusable`` quality rules).
    """
    return F.col(name).try_cast("decimal(20,6)")


def money(total: Column) -> Column:
    """A sum of amounts, rounded to whole cents."""
    return F.round(total, 2).cast("double")


def money_sum(name: str) -> Column:
    return money(F.sum(amount(name)))


def money_avg(name: str) -> Column:
    return share(F.sum(amount(name)), F.count(amount(name)))


def money_mean(total: Column, count: Column) -> Column:
    """Mean of amounts from their sum and number, rounded to whole cents; halves are decided exactly."""
    return F.round(F.try_divide(total, count), 2).cast("double")


def share(part: Column, total: Column) -> Column:
    """``part / total`` as a double; NULL when the total is zero or NULL."""
    return F.try_divide(part.cast("double"), total.cast("double"))


def scaled(name: str, places: int) -> Column:
    """A value with at most ``places`` decimals as a whole number of its smallest unit."""
    return F.rint(F.col(name) * float(10**places)).try_cast("bigint")


def rounded_mean(total: Column, count: Column, places: int) -> Column:
    """Mean of scaled values, rounded to ``places``. Halves are decided on exact whole numbers."""
    return F.round(share(total, count)) / F.lit(float(10**places))


def mean_of_rounded(name: str, places: int) -> Column:
    """Mean, to the same number of places, of a column that is already rounded to ``places``."""
    return rounded_mean(F.sum(scaled(name, places)), F.count(name), places)


def report_round(value: Column, places: int = 2) -> Column:
    """Rounding of report figures: scale, round half away from zero, scale back."""
    factor = F.lit(float(10**places))
    return F.round(value.cast("double") * factor) / factor
