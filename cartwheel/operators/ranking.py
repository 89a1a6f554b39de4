"""Order statistics and ranks without gathering the rows in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.scalars import as_double
from cartwheel.session import staged

#: monotonically_increasing_id keeps the partition above this many bits.
ROW_BITS = 33


def _in_order(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows sorted over ranges of ``order`` and written once, with ``part``
    (number of the range) and ``place`` (position in it)."""
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row_id", F.monotonically_increasing_id())
    place = F.col("row_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return staged(sorted_, "ordered").withColumns({"part": F.shiftright("row_id", ROW_BITS), "place": place}).drop("row_id")


def positions(rows: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Adds the place of each row in the whole order, from 0.

    A range sort gives a row's place in its range; the ranges before it are
    added up over one row per range.  ``order`` should tell rows apart, since
    rows equal in it lie in one range.
    """
    ordered = _in_order(rows, order)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    starts = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return ordered.join(starts, "part").withColumn(name, F.col("start") + F.col("place")).drop("part", "place", "start")


def running_totals(rows: DataFrame, order: str, sums: Sequence[str]) -> DataFrame:
    """Adds ``<name>_before``: each column's sum over all rows that come before
    in ``order``, whose values must differ from row to row."""
    ordered = _in_order(rows, [order])
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    totals = ordered.groupBy("part").agg(*[F.sum(name).alias(name) for name in sums])
    starts = totals.select("part", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"{name}_start") for name in sums])
    summed = ordered.withColumns({f"{name}_inside": F.coalesce(F.sum(name).over(inside), F.lit(0)) for name in sums})
    return summed.join(starts, "part").select(
        *rows.columns, *[(F.col(f"{name}_start") + F.col(f"{name}_inside")).alias(f"{name}_before") for name in sums]
    )


def exact_quantiles(
    rows: DataFrame, column: str, shares: Sequence[float], accuracy: int = 1000, at_once: int = 10_000
) -> list[float | None]:
    """The smallest value that at least each share of the values does not
    exceed; None without values.  NULL and NaN are no values.

    Each pass takes a few pivots around the wanted rank from a mergeable
    sketch, then counts exactly how many rows lie below and on each.  The rank
    either falls on a pivot, which is the answer, or between two, and the next
    pass looks there only.  A pivot is a value of the rows and is left out of
    the next pass, so it ends; the sketch's error makes each pass some
    ``accuracy / 4`` times smaller.  Once at most ``at_once`` rows are left
    their values come to the driver.
    """
    value = as_double(column).alias("v")
    values = rows.select(value).where("v IS NOT NULL AND NOT isnan(v)")
    total = values.count()
    if not total:
        return [None] * len(shares)
    return [_ranked(values, max(1, math.ceil(Decimal(str(share)) * total)), total, accuracy, at_once) for share in shares]


def _ranked(values: DataFrame, rank: int, left: int, accuracy: int, at_once: int) -> float:
    """The value with the given rank, from 1."""
    v = F.col("v")
    while left > at_once:
        middle, step = rank / left, 2 / accuracy
        fractions = [min(max(middle + n * step, 0.0), 1.0) for n in (-1, 0, 1)]
        pivots = sorted(set(values.agg(F.percentile_approx(v, fractions, accuracy)).first()[0]))
        counts = values.agg(*[F.count_if(v < p).alias(f"below{i}") for i, p in enumerate(pivots)], *[F.count_if(v <= p).alias(f"upto{i}") for i, p in enumerate(pivots)]).first()
        low, high, skipped, upper = None, None, 0, left
        for i, pivot in enumerate(pivots):
            if counts[f"below{i}"] < rank <= counts[f"upto{i}"]:
                return pivot
            if counts[f"upto{i}"] < rank:
                low, skipped = pivot, counts[f"upto{i}"]
            elif high is None:
                high, upper = pivot, counts[f"below{i}"]
        if low is not None:
            values = values.where(v > low)
        if high is not None:
            values = values.where(v < high)
        rank, left = rank - skipped, upper - skipped
    for row in values.groupBy("v").agg(F.count(F.lit(1)).alias("rows")).orderBy("v").collect():
        if rank <= row.rows:
            return row.v
        rank -= row.rows
    raise AssertionError("rank beyond the rows")
