"""Stored row history, switched from one whole version to the next.

A history is a folder with, for each run, the rows that run closed
(``closed-<n>``) and all rows open after it (``open-<n>``).  Version n is
``open-<n>`` and every ``closed`` up to n.  The empty file ``current/<n>`` makes it
the version that readers see; it is put there once both folders are whole.  A run
that dies before leaves the last version as it was, and the next run writes over
what it left.

A run reads and writes open rows only, one per key, however long the history is.
Open rows carry a hash of the columns that are tracked, so a change shows in one
comparison and old values need not be read again column by column.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.history import VALID_TO, first_snapshot, scd2_check
from cartwheel.session import staged
from cartwheel.sinks import files
from cartwheel.sinks.tables import require_unique
from cartwheel.sinks.versions import Marks, folder_name

OPEN, CLOSED, READER = "open-", "closed-", "current"
ROW_HASH = "row_hash"
#: Open sets kept behind the current one, for readers that are still at work.
KEPT = 1


def row_hash(columns: Sequence[str]) -> Column:
    """Digest of the columns; NULL and a value differ, also the text of it."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def _version(spark: SparkSession, path: str) -> int:
    return Marks(spark, path).read(READER)


def _folder(path: str, kind: str, number: int) -> str:
    return f"{path.rstrip('/')}/{folder_name(kind, number)}"


def read_history(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """All rows of the current version, with ``closed_month`` (``open`` for
    open rows)."""
    number = _version(spark, path) if version is None else version
    if not number:
        raise ValueError(f"no history at {path}")
    opened = spark.read.parquet(_folder(path, OPEN, number)).drop(ROW_HASH)
    closed = spark.read.schema(opened.schema).parquet(*[_folder(path, CLOSED, n) for n in range(1, number + 1)])
    month = F.coalesce(F.date_format(VALID_TO, "yyyy-MM"), F.lit("open"))
    return opened.unionByName(closed).withColumn("closed_month", month)


def snapshot_table(current: DataFrame, path: str, key: str, check_columns: Sequence[str], as_of: dt.datetime) -> int:
    """Brings the history at ``path`` up to date; returns its version.

    A key that is NULL or occurs twice in ``current`` is refused: it would
    open one more row on each run.
    """
    spark = current.sparkSession
    require_unique(current, [key])
    if not current.where(F.col(key).isNull()).limit(1).isEmpty():
        raise ValueError(f"NULL in the key {key}")
    before = _version(spark, path)
    number = before + 1
    rows = current.withColumn(ROW_HASH, row_hash(list(check_columns)))
    if not before:
        state = first_snapshot(rows, key, as_of)
    else:
        opened = spark.read.parquet(_folder(path, OPEN, before))
        state = scd2_check(opened, rows, key, [ROW_HASH], as_of)
    state = staged(state, "snapshot")
    state.where(F.col(VALID_TO).isNotNull()).drop(ROW_HASH).write.mode("overwrite").parquet(_folder(path, CLOSED, number))
    state.where(F.col(VALID_TO).isNull()).write.mode("overwrite").parquet(_folder(path, OPEN, number))
    Marks(spark, path).move(READER, number)
    for name in files.names(spark, path):
        if name.startswith(OPEN) and int(name[len(OPEN):]) < number - KEPT:
            files.delete(spark, f"{path.rstrip('/')}/{name}")
    return number
