"""Session settings the operators expect, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from cartwheel.sinks import files

# Spark settings that change results (time zone) or let Spark repair skew and
# partition counts at run time.  Sizes are left to the cluster's own defaults.
# Forcing the skew join makes Spark split a hot key even where the split costs
# one more shuffle further up.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Shuffled bytes of a merged partition: some 350,000 order lines.
MERGED = "8m"


def local_session(name: str, cores: str = "8", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Applies the settings to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the folder named by ``spark.checkpoint.dir``.

    Every executor must see it, so a cluster session has to name one; only a
    local master may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{root.rstrip('/')}/cartwheel/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: what follows can be read several times, and a lost
    executor costs a re-read of files, not a re-run of the plan above.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Staged copies that end with a ``with`` block, whether or not it fails.

    A stream or a table that is merged into again and again would otherwise
    fill the shared folder with copies nobody reads any more.  ``drop`` ends
    one sooner.  They are written once and read a few times, so they are
    packed more tightly than tables.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for label in [*self.paths]:
            self.drop(label)

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """As ``staged``; labels of a block differ."""
        self.paths[label] = shared_dir(self.spark, label)
        df.write.mode("errorifexists").option("compression", "zstd").parquet(self.paths[label])
        return self.spark.read.schema(df.schema).parquet(self.paths[label])

    def drop(self, label: str) -> None:
        files.delete(self.spark, self.paths.pop(label))


def spread(rows: DataFrame, per_task: int, *keys: str) -> DataFrame:
    """``rows`` dealt out by ``keys``, about ``per_task`` of them to a task.

    For small files whose rows grow large in later steps: Spark cuts its read
    tasks by bytes and row groups, so a few would do all the work.  Rows that
    fit one task stay as they are.  Counts them, which reads footers only where
    the files are Parquet.
    """
    tasks = -(-rows.count() // per_task)
    return rows.repartition(tasks, *keys) if tasks > 1 else rows


def size_shuffles(rows: DataFrame, per_task: int = 50_000) -> DataFrame:
    """Lets the shuffles of this session start with about ``per_task`` of
    ``rows`` to a partition; returns ``rows``.

    A fixed number of shuffle partitions makes a task's sorts and hash tables
    grow with the input.  Adaptive execution merges what turns out small, up to
    ``MERGED`` bytes, and still splits hot keys of a join.  Numbers are only
    ever made finer, and not at all where the session's own are enough.
    """
    conf = rows.sparkSession.conf
    tasks = -(-rows.count() // per_task)
    if tasks > int(conf.get(INITIAL, None) or conf.get("spark.sql.shuffle.partitions")):
        conf.set(INITIAL, str(tasks))
        conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", MERGED)
    return rows
