"""Session records that are delivered late, twice and corrected.

Collectors send a session more than once: again because an answer was lost, or
corrected.  ``delivered_at`` says when a record was sent; the newest one of a
session counts, in whatever order they arrive.

* A state keyed by a hash of the session holds the newest delivery of each
  session for ``remember``.  It drops repeats and overtaken records before
  anything is written.
* What passes is compared with the stored session, so an old record that turns
  up after its session left the state changes nothing either.
* A session that is sent after its start day was closed is filed under the day
  it was sent, so the daily job of that day takes it.  One that was filed under
  its start day and is corrected later moves.
* A session's actions are replaced as a whole: those a correction no longer has
  leave the table.
* A batch that is replayed after a crash changes nothing, also for sessions
  without an id, which are all different sessions.

The state grows with the sessions of ``remember`` days.  At that size choose
Spark's RocksDB state store, which keeps it on disk.
"""

from __future__ import annotations

import datetime as dt
import uuid
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructField, StructType, TimestampType

from cartwheel.functions.scalars import as_stamp
from cartwheel.operators.activity import session_actions, session_columns
from cartwheel.schemas import ACTIVITY_LOG
from cartwheel.session import Scratch, prepare
from cartwheel.sinks.tables import merge_into, newest, stored_rows
from cartwheel.streaming.ingest import ACTION_PARTITIONS, started

DELIVERY = StructType([*ACTIVITY_LOG.fields, StructField("delivered_at", TimestampType())])
#: Order of two deliveries of a session: time, then content, so a tie has one
#: outcome whatever the order of arrival.
ORDER = ["sent", "content"]
#: States of a stream; fixed once it has a checkpoint.
BUCKETS = 4096
#: Settings of the stream.  State that is due to leave makes Spark run batches
#: without data, for ever; it can wait for the next data.  Shuffle files else
#: stay until the driver happens to collect its garbage.
STREAM = {
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def filing_day(closing: dt.timedelta = dt.timedelta(hours=2)) -> Column:
    """Start day of a session, or the day it was sent if that is later than
    ``closing`` after the end of the start day.  Without a time sent the start
    day, without a start the day sent."""
    start = F.to_date(as_stamp("timestamp"))
    closed = F.date_add(start, 1).cast("timestamp") + F.lit(closing)
    return F.when(F.col("delivered_at") >= closed, F.to_date("delivered_at")).otherwise(F.coalesce(start, F.to_date("delivered_at")))


def delivered(lines: DataFrame) -> DataFrame:
    """Records of JSON lines with what the state compares, and the line itself
    (``value``).  Lines that hold no record are left out."""
    record = F.from_json("value", DELIVERY).alias("record")
    rows = lines.select("value", record).where("record.event_id IS NOT NULL OR record.session_id IS NOT NULL OR record.timestamp IS NOT NULL")
    content = F.xxhash64(*[F.col(f"record.{f.name}") for f in ACTIVITY_LOG.fields])
    sent = F.coalesce(F.unix_micros("record.delivered_at"), F.lit(0))
    return rows.select(F.col("record.session_id").alias("session_id"), sent.alias("sent"), content.alias("content"), "value")


def _passing(rows: list[tuple[int, int]], known: tuple[int, int] | None) -> tuple[int | None, tuple[int, int] | None]:
    """Of a session's sorted ``(sent, content)`` the place of the one that
    passes, if any, and the newest that is known then."""
    start = 0 if known is None else bisect_right(rows, known)
    if start == len(rows):
        return None, known
    at = len(rows) - 1
    # Of the newest content, the first time it was sent.
    while at > start and rows[at - 1][1] == rows[-1][1]:
        at -= 1
    # The same content sent again only moves the time.
    repeat = known is not None and at == start and rows[-1][1] == known[1]
    return (None if repeat else at), rows[-1]


def _newest_of_state(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState, remember: dt.timedelta) -> Iterator[pd.DataFrame]:
    """The rule for the state of one session; ``_newest_of_bucket`` applies it
    to many at once."""
    if state.hasTimedOut:
        state.remove()
        return
    rows = pd.concat(list(frames)).sort_values(ORDER)
    at, known = _passing([*zip(rows.sent.tolist(), rows.content.tolist())], tuple(state.get) if state.exists else None)
    if known is not None:
        state.update(known)
    if at is not None:
        yield rows.iloc[[at]]
    state.setTimeoutDuration(int(remember.total_seconds() * 1000))


def _packed(known: dict[str, tuple[int, int, int]]) -> bytes:
    """The sessions of a state with sent, content and last time seen, as an
    Arrow stream."""
    columns = [*zip(*known.values())] or [(), (), ()]
    table = pa.table([pa.array([*known], pa.string()), *[pa.array(c, pa.int64()) for c in columns]], names=["session_id", "sent", "content", "seen"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(state: bytes) -> dict[str, tuple[int, int, int]]:
    ids, *columns = (c.to_pylist() for c in pa.ipc.open_stream(state).read_all().columns)
    return dict(zip(ids, zip(*columns)))


def _newest_of_bucket(frames: Iterable[pd.DataFrame], state: GroupState, remember: dt.timedelta, now: int) -> Iterator[pd.DataFrame]:
    """``now`` in milliseconds.  A session leaves ``remember`` after it was last
    seen, with the next records of its bucket; a bucket without any times out."""
    if state.hasTimedOut:
        state.remove()
        return
    due = int(remember.total_seconds() * 1000)
    rows = pd.concat(list(frames), ignore_index=True)
    nameless = rows["session_id"].isna()
    named = rows[~nameless].sort_values(["session_id", *ORDER])
    ids, pairs = named["session_id"].tolist(), [*zip(named["sent"].tolist(), named["content"].tolist())]
    known = _unpacked(state.get[0]) if state.exists else {}
    passed, first = [], 0
    for end in range(1, len(ids) + 1):
        if end < len(ids) and ids[end] == ids[first]:
            continue
        before = known.get(ids[first])
        at, last = _passing(pairs[first:end], before and before[:2])
        known[ids[first]] = (*last, now)
        if at is not None:
            passed.append(first + at)
        first = end
    state.update((_packed({key: value for key, value in known.items() if value[2] + due > now}),))
    state.setTimeoutDuration(due)
    yield pd.concat([named.iloc[passed], rows[nameless]]).drop(columns="bucket")


def newest_deliveries(stream: DataFrame, remember: dt.timedelta) -> DataFrame:
    """Records of ``delivered`` that are newer than what the state has seen of
    their session; records without a session id all pass.

    A state holds the sessions of one of ``BUCKETS`` buckets: a call into
    Python for each session would cost more than all else.
    """

    def choose(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        return _newest_of_bucket(frames, state, remember, state.getCurrentProcessingTimeMs())

    # Records without an id are spread by their content.
    bucket = F.pmod(F.xxhash64(F.coalesce("session_id", "value")), F.lit(BUCKETS))
    return stream.withColumn("bucket", bucket).groupBy("bucket").applyInPandasWithState(
        choose, stream.schema, "sessions binary", "append", GroupStateTimeout.ProcessingTimeTimeout
    )


def merge_batch(batch: DataFrame, sessions: str, actions: str, token: str, closing: dt.timedelta) -> None:
    """Merges one batch of ``delivered`` records into both tables.

    Actions go first: the stored session tells a repeat that its record has
    been merged, so it must be the last thing to change.
    """
    record = F.from_json("value", DELIVERY).alias("record")
    with Scratch(batch.sparkSession) as scratch:
        lines = _newest_lines(scratch.keep(batch, "batch"))
        rows = scratch.keep(lines.select(record).select("record.*").withColumn("ingest_date", filing_day(closing)), "deliveries")
        scratch.drop("batch")
        stored = stored_rows(_sessions(rows), sessions, ["session_id"], ACTION_PARTITIONS, ["delivered_at"])
        if stored is not None:
            sent = rows.where("session_id IS NOT NULL").select("session_id", "delivered_at")
            fresh = newest(sent, stored, ["session_id"], "delivered_at").select("session_id")
            rows = scratch.keep(rows.join(fresh, "session_id", "left_semi").unionByName(rows.where("session_id IS NULL")), "fresh")
            scratch.drop("deliveries")
        keys = rows.select("session_id").where("session_id IS NOT NULL")
        merge_into(session_actions(rows), actions, ["session_id"], ACTION_PARTITIONS, token=token, removed=keys)
        merge_into(_sessions(rows), sessions, ["session_id"], ACTION_PARTITIONS, token=token)


def _newest_lines(batch: DataFrame) -> DataFrame:
    """The newest line of each session, and all those without a session id.

    Lines are only shuffled if a session has several; those that passed the
    state are one a session.
    """
    named = batch.where("session_id IS NOT NULL")
    if named.groupBy("session_id").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1").take(1):
        named = named.groupBy("session_id").agg(F.max(F.struct(*ORDER, "value")).alias("last")).select(F.col("last.value").alias("value"))
    return named.select("value").unionByName(batch.where("session_id IS NULL").select("value"))


def _sessions(rows: DataFrame) -> DataFrame:
    return rows.select("delivered_at", *session_columns())


def merge_deliveries(
    spark: SparkSession,
    landing: str,
    sessions: str,
    actions: str,
    checkpoint: str,
    max_files: int = 1000,
    every: str | None = None,
    closing: dt.timedelta = dt.timedelta(hours=2),
    remember: dt.timedelta = dt.timedelta(days=3),
) -> StreamingQuery:
    """Keeps the session and action tables at the newest delivery of each
    session.  JSON lines as landed, with ``delivered_at`` as a time."""
    prepare(spark)
    # Batches of one checkpoint have the same name whenever they are run.
    name = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex

    def merge(batch: DataFrame, number: int) -> None:
        merge_batch(batch, sessions, actions, f"{name}-{number}", closing)

    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(landing)
    writer = (
        newest_deliveries(delivered(lines), remember)
        .writeStream.outputMode("append")
        .foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
    )
    # The query keeps the settings of its start.
    before = {key: spark.conf.get(key, None) for key in STREAM}
    for key, value in STREAM.items():
        spark.conf.set(key, value)
    try:
        return started(writer, every)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
