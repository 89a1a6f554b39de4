"""Near-duplicate documents by MinHash banding and connected components.

Method.  Every document's set of distinct five-word shingles is hashed by many
universal functions; the minima are cut into bands, and equal bands put
documents into one bucket.  Copies with equal sets are folded into one
representative first.  Buckets never emit all their pairs: each member is
compared with the bucket's least id and links merge into components.  Members
of a bucket that are still in different components are then compared in blocks
inside tasks, which give out at most one link for each merge.  Pairs pass a
signature check and are then confirmed on full sets.

With ``rows = 6`` and ``bands = 48`` a pair at a similarity of 0.75 shares no
bucket with a probability below 1 in 12,000; at 0.8 below 1 in two million.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import map_batches, mix, table
from cartwheel.llm.components import connected_components
from cartwheel.session import staged

WORDS = 5
BANDS = 48
ROWS = 6
#: Similarity in hundredths from which two documents are linked.
PERCENT = 75
#: Pairs whose signatures agree less than this are below the threshold: five
#: standard deviations at 0.75 with 288 minima.
SIGNATURE_FLOOR = 0.62
#: Members of a bucket that a task holds on either side of a comparison.
BLOCK = 1024
#: Members compared with one leader in one go; more go to further tasks.
CHUNK = 256


class _Powers:
    """Powers of an odd number modulo 2^64 and of its inverse, grown on need."""

    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 2**64)

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, size: int) -> None:
        if size > len(self.up):
            for name, factor in (("up", self.base), ("down", self.inverse)):
                steps = np.full(2 * size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))


_POWERS = _Powers()
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
# A random number a byte; A-Z share those of a-z.
_BYTE = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2)
_BYTE[65:91] = _BYTE[97:123]


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of each word between ASCII blanks, A-Z taken as a-z.

    All words at once: sums over byte * power, shifted back to the word's
    start by the inverse power.
    """
    raw = np.frombuffer(text, np.uint8)
    solid = np.concatenate([[False], ~_BLANK[raw], [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    _POWERS.reach(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _POWERS.up[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _POWERS.down[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: bytes | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; a shorter text
    is one shingle, a text without words has none."""
    own = word_hashes(text) if text else np.empty(0, np.uint64)
    if not len(own):
        return own
    size = min(size, len(own))
    total = np.full(len(own) - size + 1, size, np.uint64)
    for i, factor in enumerate(_factors(size)):
        total += own[i : i + len(total)] * factor
    return np.unique(mix(total))


@lru_cache
def _factors(size: int) -> np.ndarray:
    return np.random.default_rng(size).integers(1, 2**63, size, dtype=np.uint64) | np.uint64(1)


@lru_cache
def _universal(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20_240_601)
    a = draw.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, draw.integers(0, 2**63, count, dtype=np.uint64)


def minima(items: np.ndarray, count: int) -> np.ndarray:
    """Minimum of ``count`` multiply-shift hashes over the items."""
    a, b = _universal(count)
    keys = items >> np.uint64(32)
    best = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(keys), 256):
        grid = np.multiply.outer(keys[start : start + 256], a)
        grid += b
        np.minimum(best, grid.min(axis=0), out=best)
    return best >> np.uint64(32)


def band_keys(best: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key a band, different bands never sharing a key by rule."""
    grid = best.reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(rows):
        key = mix(key ^ grid[:, i])
    return key.view(np.int64)


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """``doc_id, n_shingles, digest, bands, sketch`` of each row.

    ``digest`` stands for the whole set, ``sketch`` keeps one byte a minimum.
    Rows without words have NULL for all three.
    """
    def work(ids: list, texts: list) -> dict:
        out = {"doc_id": ids, "n_shingles": [], "digest": [], "bands": [], "sketch": []}
        for text in texts:
            items = shingle_set(text, words)
            out["n_shingles"].append(len(items))
            if len(items):
                best = minima(items, bands * rows)
                out["digest"].append(hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                out["bands"].append(band_keys(best, bands, rows))
                out["sketch"].append(best.astype(np.uint8).tobytes())
            else:
                for name in ("digest", "bands", "sketch"):
                    out[name].append(None)
        return out

    return map_batches(
        docs.select("doc_id", "text"),
        "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>, sketch binary",
        work,
    )


def _likely(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` whose signatures agree often enough."""

    def work(first: list, second: list, one: list, two: list) -> dict:
        agree = [
            np.mean(np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8)) >= SIGNATURE_FLOOR
            for x, y in zip(one, two, strict=True)
        ]
        return {"a": [x for x, ok in zip(first, agree, strict=True) if ok], "b": [x for x, ok in zip(second, agree, strict=True) if ok]}

    left = sketches.select(F.col("doc_id").alias("a"), F.col("sketch").alias("one"))
    right = sketches.select(F.col("doc_id").alias("b"), F.col("sketch").alias("two"))
    return map_batches(
        pairs.join(left, "a").join(right, "b").select("a", "b", "one", "two"), "a bigint, b bigint", work
    ).distinct()


def _confirm(pairs: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """Pairs whose full sets reach the threshold.

    The texts of one leader's partners follow the leader's own in a stream,
    so a task holds two sets at a time.  A leader with many partners is dealt
    to several tasks.
    """
    many = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("partners"))
    dealt = pairs.join(many, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("partners") / CHUNK)).cast("int").alias("chunk")
    )
    wanted = dealt.select(F.col("b").alias("doc_id"), "a", "chunk", F.lit(1).alias("role")).unionByName(
        dealt.select(F.col("a").alias("doc_id"), "a", "chunk", F.lit(0).alias("role")).distinct()
    )
    rows = (
        texts.join(wanted, "doc_id")
        .select("a", "chunk", "role", "doc_id", "text")
        .repartition("a", "chunk")
        .sortWithinPartitions("a", "chunk", "role")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, leaders = None, []
        for batch in batches:
            found: tuple[list, list] = ([], [])
            for a, chunk, role, other, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (a, chunk) != group:
                    group, leaders = (a, chunk), []
                items = shingle_set(text.encode(), words)
                if role == 0:
                    leaders.append(items)
                    continue
                for own in leaders:
                    shared = len(np.intersect1d(own, items, assume_unique=True))
                    if 100 * shared >= percent * (len(own) + len(items) - shared):
                        found[0].append(a)
                        found[1].append(other)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["a", "b"])

    return rows.mapInArrow(compare, "a bigint, b bigint")


def _cells(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """``key, big, small, side, doc_id, component``: the members of buckets
    with several components, dealt to cells of two blocks.

    A bucket's members outside its largest component (side 1) meet all of
    that component (side 0) and each other; those inside it never meet again.
    """
    placed = buckets.select("key", "doc_id").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "key", "doc_id", F.coalesce("component", "doc_id").alias("component")
    )
    sizes = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    shape = (
        sizes.groupBy("key")
        .agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("members"), F.count(F.lit(1)).alias("components"))
        .where("components > 1")
        .select(
            "key",
            F.col("top.component").alias("largest"),
            F.ceil(F.col("top.n") / BLOCK).cast("int").alias("bigs"),
            F.ceil((F.col("members") - F.col("top.n")) / BLOCK).cast("int").alias("smalls"),
        )
    )
    member = placed.join(shape, "key").withColumn("side", (F.col("component") != F.col("largest")).cast("int"))
    blocks = F.when(F.col("side") == 0, F.col("bigs")).otherwise(F.col("smalls"))
    own = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    span = lambda count: F.sequence(F.lit(0), count - 1)
    inside = F.transform(span(F.col("smalls")), lambda s: F.struct(F.col("own").alias("big"), s.alias("small")))
    across = F.transform(span(F.col("bigs")), lambda k: F.struct(k.alias("big"), F.col("own").alias("small")))
    # Two blocks of side 1 meet in a cell numbered below zero.
    among = F.transform(
        F.filter(span(F.col("smalls")), lambda t: t != F.col("own")),
        lambda t: F.struct((-1 - F.least(t, F.col("own"))).alias("big"), F.greatest(t, F.col("own")).alias("small")),
    )
    return (
        member.withColumn("own", own)
        .withColumn("cell", F.explode(F.when(F.col("side") == 0, inside).otherwise(F.concat(across, among))))
        .select("key", "cell.big", "cell.small", "side", "doc_id", "component")
    )


def _merge_cells(cells: DataFrame, schema: str, percent: int, words: int) -> DataFrame:
    """Runs over the cells one by one.

    Rows without a text: gives out the rows with a likely partner in another
    component.  Rows with one: gives out confirmed links between components.
    """
    exact = "text" in cells.columns
    dealt = cells.repartition("key", "big", "small").sortWithinPartitions("key", "big", "small")
    names = dealt.columns

    def compare(rows: list[dict]) -> list[tuple]:
        sketches = np.array([np.frombuffer(r["sketch"], np.uint8) for r in rows])
        label = np.array([r["component"] for r in rows])
        sets: dict[int, np.ndarray] = {}
        marked, links = set(), []
        for x in (i for i, r in enumerate(rows) if r["side"] == 1):
            agree = (sketches == sketches[x]).mean(axis=1)
            near = np.flatnonzero((agree >= SIGNATURE_FLOOR) & (label != label[x]))
            if not exact:
                marked.update(near.tolist(), [x] if len(near) else [])
                continue
            for y in near[np.argsort(-agree[near])].tolist():
                if label[x] == label[y]:
                    continue
                for z in (x, y):
                    if z not in sets:
                        sets[z] = shingle_set(rows[z]["text"].encode(), words)
                shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * shared >= percent * (len(sets[x]) + len(sets[y]) - shared):
                    links.append((rows[x]["doc_id"], rows[y]["doc_id"]))
                    label[label == label[y]] = label[x]
        if exact:
            return links
        return [(rows[i]["key"], rows[i]["big"], rows[i]["small"], rows[i]["side"], rows[i]["doc_id"], rows[i]["component"]) for i in sorted(marked)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []

        def out(found: list[tuple]) -> pa.RecordBatch:
            fields = [f.split(" ") for f in schema.split(", ")]
            kinds = {"bigint": pa.int64(), "int": pa.int32()}
            columns = list(zip(*found, strict=True)) or [()] * len(fields)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields]
            )

        for batch in batches:
            for row in batch.to_pylist():
                now = (row["key"], row["big"], row["small"])
                if now != cell:
                    if held:
                        yield out(compare(held))
                    cell, held = now, []
                held.append(row)
        if held:
            yield out(compare(held))

    return dealt.select(*names).mapInArrow(run, schema)


def _same_id(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` of a doc_id with different sets to the representatives
    of each."""
    mark = F.xxhash64("digest")
    several = signed.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(mark).alias("least"), F.max(mark).alias("most")).where("least < most")
    own = signed.join(several.select("doc_id"), "doc_id", "left_semi").select("doc_id", "digest").distinct()
    return own.join(classes, "digest").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))


def near_duplicates(
    docs: DataFrame,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    words: int = WORDS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when ``100 * intersection >= percent * union`` of
    their shingle sets; a component's id is its least ``doc_id``.

    NULL, empty or blank text: no shingles, linked with nothing, kept.  NULL
    ``doc_id``: component of the documents with an equal set, else NULL (and
    kept).  Rows that share a ``doc_id`` are one node of the graph: it is
    linked with whatever one of its texts is linked with, in any order of the
    rows.  Its different texts are compared with all of a partner's, so an id
    is meant for few of them.  Other columns are ignored.  No rows in, no rows
    out.
    """
    signed = staged(signatures(docs, bands, rows, words), "signatures")
    worded = signed.where("n_shingles > 0")
    classes = worded.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    leads = staged(
        worded.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "bands", "sketch"),
        "representatives",
    )
    keyed = leads.select("doc_id", F.explode("bands").alias("key")).distinct()
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("doc_id").alias("leader")).where("members > 1")
    buckets = staged(keyed.join(shared.select("key", "leader"), "key"), "buckets")
    # More than one sketch where rows with different texts share the id.
    sketches = leads.select("doc_id", "sketch").distinct()

    pairs = buckets.where("doc_id <> leader").select(F.col("leader").alias("a"), F.col("doc_id").alias("b")).distinct()
    likely = staged(_likely(pairs, sketches), "pairs")
    involved = buckets.select("doc_id").distinct()
    texts = staged(docs.select("doc_id", "text").where("text IS NOT NULL").join(involved, "doc_id", "left_semi"), "texts")
    edges = staged(
        _confirm(likely, texts, percent, words).unionByName(_same_id(worded, classes)).distinct(), "links"
    )
    cells = _cells(buckets, connected_components(edges))
    likely_rows = staged(
        _merge_cells(
            cells.join(sketches, "doc_id").select("key", "big", "small", "side", "doc_id", "component", "sketch"),
            "key bigint, big int, small int, side int, doc_id bigint, component bigint", percent, words,
        ),
        "cells",
    )
    with_text = (
        likely_rows.join(sketches, "doc_id")
        .join(texts, "doc_id")
        .select("key", "big", "small", "side", "doc_id", "component", "sketch", "text")
    )
    more = staged(_merge_cells(with_text, "a bigint, b bigint", percent, words), "links")
    found = connected_components(edges.unionByName(more))
    rep_of = classes.join(found, F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "rep").alias("of_class")
    )
    placed = signed.select("doc_id", "n_shingles", "digest").join(rep_of, "digest", "left")
    component = F.coalesce("of_class", "doc_id")
    return placed.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
                      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM words
), items AS (SELECT doc_id, unnest(s) AS sh FROM sets),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS c FROM items a JOIN items b ON a.sh = b.sh GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT doc_id, n AS n_shingles, COALESCE(m, doc_id) AS component_id, doc_id = COALESCE(m, doc_id) AS kept
FROM sizes LEFT JOIN (SELECT x, MIN(y) AS m FROM reach GROUP BY x) g ON g.x = sizes.doc_id
"""
