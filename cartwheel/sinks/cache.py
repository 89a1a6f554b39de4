"""Stored results with a build time, inputs and an expiry day.

A cached table is a numbered folder ``build-<n>`` under its own name.  When it
was built, until when it holds and which state its inputs had lie in one small
file beside it, written once the rows are there.  A build is used while its day
has not passed and its inputs say the same; otherwise it is built anew, and
``sweep`` drops what has expired.  Times are parameters, so runs can be repeated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cartwheel.sinks import files
from cartwheel.sinks.versions import ChangeLog, folder_name, numbers

BUILD, ABOUT = "build-", "about-"
DAYS = 7


@dataclass(frozen=True)
class TableCache:
    """Cached tables under ``root``; each holds for ``days`` days."""

    spark: SparkSession
    root: str
    days: int = DAYS

    def _path(self, name: str, kind: str, number: int) -> str:
        return f"{self.root.rstrip('/')}/{name}/{folder_name(kind, number)}"

    def _about(self, name: str, number: int) -> dict | None:
        row = self.spark.read.parquet(self._path(name, ABOUT, number)).first()
        return {"built_at": row.built_at, "expires": row.expires, "inputs": dict(row.inputs)}

    def builds(self, name: str) -> list[int]:
        return numbers(self.spark, f"{self.root.rstrip('/')}/{name}", ABOUT)

    def inputs_of(self, paths: Mapping[str, str]) -> dict[str, str]:
        """The state of tables that have a change log: its last number."""
        return {name: str(ChangeLog(self.spark, path).last()) for name, path in paths.items()}

    def get(
        self, name: str, build: Callable[[], DataFrame], now: dt.datetime, inputs: Mapping[str, str] | None = None
    ) -> DataFrame:
        """The cached rows, built if there are none, they have expired, or
        ``inputs`` (any names and states) differ from those they were built on."""
        inputs = dict(inputs or {})
        known = self.builds(name)
        if known:
            about = self._about(name, known[-1])
            if now < about["expires"] and about["inputs"] == inputs:
                return self.spark.read.parquet(self._path(name, BUILD, known[-1]))
        number = (known[-1] if known else 0) + 1
        build().write.mode("overwrite").parquet(self._path(name, BUILD, number))
        about = [(now, now + dt.timedelta(days=self.days), inputs)]
        self.spark.createDataFrame(about, "built_at timestamp, expires timestamp, inputs map<string, string>").coalesce(1).write.mode(
            "overwrite"
        ).parquet(self._path(name, ABOUT, number))
        return self.spark.read.parquet(self._path(name, BUILD, number))

    def sweep(self, now: dt.datetime) -> list[str]:
        """Drops expired and replaced builds; returns their names and numbers.

        The file that makes a build count goes first.
        """
        dropped = []
        for name in files.names(self.spark, self.root):
            known = self.builds(name)
            for number in known:
                if number != known[-1] or now >= self._about(name, number)["expires"]:
                    files.delete(self.spark, self._path(name, ABOUT, number))
                    files.delete(self.spark, self._path(name, BUILD, number))
                    dropped.append(f"{name}/{number}")
        return dropped
