"""Column helpers shared by the operators.  All of them stay JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_long(value: ColumnLike) -> Column:
    """Key cast; text that is no number gives NULL instead of failing the job."""
    return as_col(value).try_cast("bigint")


def as_int(value: ColumnLike) -> Column:
    return as_col(value).try_cast("int")


def as_double(value: ColumnLike) -> Column:
    return as_col(value).try_cast("double")


def as_stamp(value: ColumnLike) -> Column:
    return as_col(value).try_cast("timestamp")


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def date_key(day: ColumnLike) -> Column:
    """Integer ``yyyymmdd``."""
    day = as_col(day)
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def ymd(day: ColumnLike) -> list[Column]:
    """The three partition columns of a date."""
    day = as_col(day)
    return [F.year(day).alias("year"), F.month(day).alias("month"), F.day(day).alias("day")]


def money_sum(value: ColumnLike) -> Column:
    """Sum of amounts with up to four decimals, as a double.

    Summing as decimal makes the result independent of the order in which
    partitions arrive, so a re-run task gives the same bits.
    """
    return F.sum(as_col(value).cast("decimal(18,4)")).cast("double")


def money_avg(value: ColumnLike) -> Column:
    """Mean over the non-NULL amounts; NULL when there is none."""
    value = as_col(value)
    return F.try_divide(money_sum(value), F.count(value))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, 0 when the denominator is not positive or NULL."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def quotient(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double, NULL when the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` of two counts, two decimals, halves rounded up.

    Integer arithmetic, so exact for any counts below 10^14; NULL when
    ``whole`` is 0.
    """
    part, whole = part.cast("bigint"), F.nullif(whole.cast("bigint"), F.lit(0).cast("bigint"))
    hundredths = F.call_function("div", part * 20000 + whole, whole * 2)
    return hundredths.cast("double") / F.lit(100.0)


def month_slice(year: int | None, month: int | None) -> Column:
    """Filter on the ``year``/``month`` partition columns; no slice keeps all."""
    if year is None and month is None:
        return F.lit(True)
    return (F.col("year") == year) & (F.col("month") == month)
