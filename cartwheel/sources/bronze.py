"""Readers and writers of the bronze layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwheel.schemas import BRONZE_CSV, LANDED_LOG


def read_bronze_csv(spark: SparkSession, table: str, path: str) -> DataFrame:
    """A headerless CSV extract, all columns as text.

    ``year=/month=`` folders become columns and prune the files read.
    """
    return spark.read.schema(BRONZE_CSV[table]).option("header", False).csv(path)


def land_csv(df: DataFrame, table: str, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Writes an extract in the layout ``read_bronze_csv`` expects."""
    names = [*BRONZE_CSV[table].fieldNames(), *partition_by]
    rows = df.select(*names)
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    rows.write.mode("overwrite").partitionBy(*partition_by).option(
        "partitionOverwriteMode", "dynamic" if partition_by else "static"
    ).option("header", False).csv(path)


def read_activity_logs(spark: SparkSession, path: str) -> DataFrame:
    """Nested session records, one JSON object per line, with the
    ``ingest_date`` folder as a date column.  No schema inference pass."""
    return spark.read.schema(LANDED_LOG).json(path)


def land_activity_logs(logs: DataFrame, path: str) -> None:
    """Writes session records as NDJSON under ``ingest_date=`` folders.

    The days present are replaced, so a repeated landing changes nothing.
    """
    logs.hint("rebalance", "ingest_date").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("ingest_date").json(path)


def refresh_partitions(spark: SparkSession, table: str) -> None:
    """Lets the catalog see folders that landed since the table was made."""
    spark.catalog.recoverPartitions(table)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)
