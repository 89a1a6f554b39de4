"""Distinct counts that follow changed rows without a rebuild.

For each group a table keeps how many rows hold an id (its multiplicity).  An
id counts for a group while that number is above 0.  Rows that arrive add, rows
that are replaced or leave take off, so the counts of touched groups follow
from the change alone; no other rows of the group are read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def multiplicities(rows: DataFrame, keys: Sequence[str], ids: Mapping[str, str], sign: int = 1) -> DataFrame:
    """``keys, measure, id, n``: rows per group and id, for each measure.

    ``ids`` names the id column of each measure.  NULL ids are not counted.
    ``sign=-1`` takes the rows off.
    """
    lines = F.array(*[F.struct(F.lit(name).alias("measure"), F.col(column).cast("string").alias("id")) for name, column in ids.items()])
    return (
        rows.select(*keys, F.inline(lines))
        .where("id IS NOT NULL")
        .groupBy(*keys, "measure", "id")
        .agg((F.count(F.lit(1)) * sign).alias("n"))
    )


def changed(stored: DataFrame, *changes: DataFrame) -> DataFrame:
    """The stored multiplicities after changes; entries that reach 0 go."""
    every = reduce(DataFrame.unionByName, changes, stored)
    keys = [c for c in stored.columns if c != "n"]
    return every.groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0")


def distinct_counts(stored: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row a group with the distinct ids of each measure.

    An entry is one id, so plain counts do and Spark combines them before the
    shuffle.
    """
    return stored.where("n > 0").groupBy(*keys).agg(
        *[F.count_if(F.col("measure") == name).alias(name) for name in measures]
    )
