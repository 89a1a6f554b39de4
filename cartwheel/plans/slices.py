"""Which slice of a job is next: a run log over the partitions of its input."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import SparkSession

from cartwheel.sinks import files


def partition_slices(spark: SparkSession, path: str, columns: Sequence[str], width: int = 2) -> list[str]:
    """Slices of a table from its folder names, ascending, such as
    ``1998-12`` for ``year=1998/month=12``.  No data is read; NULL partitions
    are no slice."""
    found = []

    def visit(folder: str, values: tuple[str, ...]) -> None:
        if len(values) == len(columns):
            found.append("-".join(v.zfill(width) if v.isdigit() else v for v in values))
            return
        prefix = f"{columns[len(values)]}="
        for name in files.names(spark, folder):
            value = unquote(name[len(prefix):])
            if name.startswith(prefix) and value != "__HIVE_DEFAULT_PARTITION__":
                visit(f"{folder}/{name}", (*values, value))

    visit(path.rstrip("/"), ())
    return sorted(found)


@dataclass(frozen=True)
class RunLog:
    """Slices that each job has done: empty files ``<root>/<job>/<slice>``.

    A slice is recorded once its tables are in place.  A run that dies before
    does the slice again, which the jobs allow.  The high-water mark is the last
    recorded slice; a slice that appears below it later (late data) is given by
    ``missed``.
    """

    spark: SparkSession
    root: str

    def _folder(self, job: str) -> str:
        return f"{self.root.rstrip('/')}/{job}"

    def done(self, job: str) -> list[str]:
        return files.names(self.spark, self._folder(job))

    def high_water(self, job: str) -> str | None:
        return max(self.done(job), default=None)

    def record(self, job: str, slice_: str) -> None:
        files.touch(self.spark, f"{self._folder(job)}/{slice_}")

    def next(self, job: str, available: Sequence[str]) -> str | None:
        """The first available slice above the high-water mark."""
        mark = self.high_water(job)
        return min((s for s in available if mark is None or s > mark), default=None)

    def missed(self, job: str, available: Sequence[str]) -> list[str]:
        """Available slices below the mark that no run has done."""
        mark, done = self.high_water(job), set(self.done(job))
        return sorted(s for s in available if mark is not None and s < mark and s not in done)

    def catch_up(self, job: str, available: Sequence[str], work: Callable[[str], None]) -> list[str]:
        """Does the missed slices, then all above the mark, in order."""
        todo = self.missed(job, available)
        mark = self.high_water(job)
        todo += sorted(s for s in available if mark is None or s > mark)
        for one in todo:
            work(one)
            self.record(job, one)
        return todo
