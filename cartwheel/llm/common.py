"""Reading, batching and summing helpers of the text operators."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows handled at once inside a task; a batch of long texts stays small.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_class(key: Column, classes: int) -> Column:
    """crc32 of the key's decimal text, modulo ``classes``."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(classes))


def map_batches(df: DataFrame, schema: str, work: Callable[..., dict], rows: int = BATCH_ROWS) -> DataFrame:
    """Applies ``work(columns...) -> {name: values}`` to small Arrow batches.

    Text columns arrive as lists of UTF-8 bytes (None for NULL), others as
    lists of Python values.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                columns = [
                    (pc.cast(c, pa.large_binary()) if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) else c).to_pylist()
                    for c in part.columns
                ]
                made = work(*columns)
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, pa.Array) else pa.array(v, type=f.type) for f in target for v in [made[f.name]]],
                    schema=target,
                )

    return df.mapInArrow(run, schema)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finaliser of splitmix64)."""
    z = values.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def sum_arrays(partials: DataFrame, column: str, fan_in: int = 16) -> np.ndarray | None:
    """Adds up float64 arrays held as bytes, one or more a partition.

    Partial sums meet ``fan_in`` at a time over several shuffles, so neither a
    task nor the driver receives all of them; None without rows.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(0).to_pylist():
                one = np.frombuffer(value, np.float64)
                total = one.copy() if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], [column])

    level = partials.select(column).mapInArrow(add, f"{column} binary")
    left = partials.rdd.getNumPartitions() if partials.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true" else None
    left = left or int(partials.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while left > fan_in:
        left = math.ceil(left / fan_in)
        level = level.repartition(left).mapInArrow(add, f"{column} binary")
    rows = level.repartition(1).mapInArrow(add, f"{column} binary").collect()
    return np.frombuffer(rows[0][0], np.float64).copy() if rows else None
