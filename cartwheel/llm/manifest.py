"""Merkle manifest of a dataset, with a proof for every row.

Method.  A row's digest is a leaf.  The leaves of a group (a language) form a
binary tree, the groups' roots another one.  Trees are built a block of
``2**BLOCK_BITS`` neighbours at a time, so twenty levels take two shuffles.
Proofs come from pointer jumping: every node first knows the sibling on the way
to its parent.  A self-join then looks up the node that a pointer ends at and
appends that node's siblings, which doubles the distance.  After k joins a
pointer spans ``2**k`` levels, so forty levels need six joins.  Only nodes that
a later join can meet take part: inner ones at multiples of the distance.

Scale.  Positions come from a range sort and the row counts of its partitions,
never from a window over all rows.  At level L a join key is shared by at most
``2**L`` leaves, and beyond that few nodes are left, which Spark broadcasts
below its size threshold.  A block holds at most ``2**BLOCK_BITS`` digests.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import crc_class, table
from cartwheel.session import staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_BITS = 10
#: monotonically_increasing_id keeps the partition above this many bits.
ROW_BITS = 33
NODES = "tree bigint, n bigint, level int, pos bigint, sibling binary, digest binary"


def field_bytes(value: Column) -> Column:
    """``-`` for NULL, else UTF-8 length, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(values: Sequence[Column]) -> Column:
    """Digest of a row as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field_bytes(v) for v in values]), 256))


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds ``tree`` (number of rows before the row's group), ``pos`` (the
    row's place in it, from 0) and ``n`` (rows of the group).

    Equal rows get neighbouring places, NULL sorts first.
    """
    keys = [*group, *order]
    ordered = staged(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("row", F.monotonically_increasing_id()), "ordered"
    )
    part = F.shiftright("row", ROW_BITS).alias("part")
    # One row per partition of the sort.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy(part).agg(F.count(F.lit(1)).alias("rows"))
    parts = staged(parts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before")), "parts")
    within = F.col("row").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    placed = ordered.withColumn("part", part).join(parts, "part").withColumn("at", F.col("before") + within).drop("part", "before", "row")
    if not group:
        return placed.select(*rows.columns, F.lit(0).cast("bigint").alias("tree"), F.col("at").alias("pos"), F.lit(placed.count()).cast("bigint").alias("n"))
    groups = staged(placed.groupBy(*group).agg(F.min("at").alias("tree"), F.count(F.lit(1)).alias("n")), "groups")
    same = F.lit(True)
    for name in group:
        same = same & placed[name].eqNullSafe(groups[name])
    place = (F.col("at") - F.col("tree")).alias("pos")
    return placed.join(groups, same).select(*[placed[c] for c in rows.columns], "tree", place, "n")


def parent(*digests: bytes) -> bytes:
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def block_nodes(digests: list[bytes], base: int, index: int, n: int, bits: int = BLOCK_BITS) -> tuple[list[tuple[int, int, bytes | None]], int, bytes]:
    """Level, place and sibling of the nodes of one block, whose lowest level
    is ``base`` of a tree with ``n`` leaves; then level and digest of its top."""
    nodes, level = [], base
    for step in range(bits):
        if (n - 1) >> level == 0:
            break
        first = index << (bits - step)
        nodes += [(level, first + i, digests[i ^ 1] if i ^ 1 < len(digests) else None) for i in range(len(digests))]
        digests = [parent(*digests[i : i + 2]) for i in range(0, len(digests), 2)]
        level += 1
    return nodes, level, digests[0]


def _levels(leaves: DataFrame, base: int, bits: int) -> DataFrame:
    """Nodes of ``bits`` levels above ``leaves`` (``tree, n, pos,
    digest``), and one row with a digest for the top of each block."""
    blocks = leaves.groupBy("tree", "n", F.shiftright("pos", bits).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("members")
    ).select("tree", "n", "block", F.col("members.digest").alias("digests"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                tree, n, block, digests = (batch.column(c)[at].as_py() for c in range(4))
                nodes, level, top = block_nodes(digests, base, block, n, bits)
                rows = [(tree, n, lv, pos, sibling, None) for lv, pos, sibling in nodes]
                rows.append((tree, n, level, block, None, top))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                    ["tree", "n", "level", "pos", "sibling", "digest"],
                )

    return blocks.mapInArrow(run, NODES)


def build_forest(leaves: DataFrame, bits: int = BLOCK_BITS) -> tuple[DataFrame, DataFrame, int]:
    """Every tree over ``tree, n, pos, digest``: its nodes below the root
    (``tree, level, pos, seg``, the sibling's digest or nothing), the roots
    (``tree, n, root``), and the depth of the deepest tree."""
    deepest = (leaves.agg(F.max("n")).first()[0] or 1) - 1
    rest, base, nodes, roots = leaves.select("tree", "n", "pos", "digest"), 0, [], []
    roots.append(rest.where("n = 1").select("tree", "n", F.col("digest").alias("root")))
    rest = rest.where("n > 1")
    while deepest >> base > 0:
        made = staged(_levels(rest, base, bits), "nodes")
        base += bits
        nodes.append(made.where("digest IS NULL").select("tree", "level", "pos", F.coalesce("sibling", F.lit(bytearray())).alias("seg")))
        tops = made.where("digest IS NOT NULL")
        done = F.shiftright(F.col("n") - 1, base) == 0
        roots.append(tops.where(done).select("tree", "n", F.col("digest").alias("root")))
        rest = tops.where(~done).select("tree", "n", "pos", "digest")
    if not nodes:
        spark = leaves.sparkSession
        nodes.append(spark.createDataFrame([], "tree bigint, level int, pos bigint, seg binary"))
    return _union(nodes), _union(roots), deepest.bit_length()


def _union(frames: list[DataFrame]) -> DataFrame:
    total = frames[0]
    for df in frames[1:]:
        total = total.unionByName(df)
    return total


def _jumped(pointers: DataFrame, targets: DataFrame, span: int) -> DataFrame:
    """Pointers over ``span`` levels, lengthened by those of the nodes they
    end at.  One that ended at a root meets no node and stays."""
    ends = targets.select(
        F.col("tree"), F.col("level").alias("end_level"), F.col("pos").alias("end_pos"), F.col("seg").alias("more")
    )
    at_end = pointers.withColumns({"end_level": F.col("level") + span, "end_pos": F.shiftright("pos", span)})
    return at_end.join(ends, ["tree", "end_level", "end_pos"], "left").select(
        *[F.col(c) for c in pointers.columns if c != "seg"], F.concat("seg", F.coalesce("more", F.lit(bytearray()))).alias("seg")
    )


def with_proofs(leaves: DataFrame, bits: int = BLOCK_BITS) -> tuple[DataFrame, DataFrame]:
    """Adds ``seg`` to the leaves: digests of all siblings from the leaf to
    its root, joined; also gives the roots (``tree, n, root``)."""
    nodes, roots, depth = build_forest(leaves, bits)
    own = nodes.where("level = 0").select("tree", "pos", "seg")
    empty = F.coalesce("seg", F.lit(bytearray())).alias("seg")
    pointers = leaves.join(own, ["tree", "pos"], "left").select(*leaves.columns, F.lit(0).alias("level"), empty)
    inner, span = nodes.where("level > 0"), 1
    while span < depth:
        ends = inner.where(F.col("level") % (2 * span) == span)
        pointers = _jumped(pointers, ends.where(F.col("level") == span), span)
        span *= 2
        if span < depth:
            inner = staged(_jumped(inner.where(F.col("level") % span == 0), ends, span // 2), "pointers")
    return pointers.drop("level"), roots


def folded(start: str, seg: str, pos: str, n: str) -> str:
    """SQL for the root that a digest and its siblings give, as hex text."""
    at = f"shiftright({pos}, l)"
    sibling = f"lower(hex(substring({seg}, s.at, 32)))"
    return f"""aggregate(
        filter(sequence(0, 62), l -> shiftright({n} - 1, l) > 0), named_struct('h', {start}, 'at', 1),
        (s, l) -> if(({at} ^ 1) > shiftright({n} - 1, l),
            named_struct('h', sha2(s.h, 256), 'at', s.at),
            named_struct('h', sha2(if({at} & 1 = 1, concat({sibling}, s.h), concat(s.h, {sibling})), 256), 'at', s.at + 32)),
        s -> s.h)"""


def hex_text(name: str) -> Column:
    return F.lower(F.hex(name))


def manifest(docs: DataFrame, tampered: Column | None = None, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``doc_id, lang, leaf, subroot, root, proof_sha256, folded_root,
    verified`` of every row.

    ``tampered`` is a condition on rows whose character count is taken one
    higher when their proof is checked; trees are built ``block_bits`` levels
    at a time.  NULL ids come first, rows that share
    an id follow each other by digest, equal rows are leaves of their own.
    NULL fields, empty and very long texts are digested as they are, other
    columns are not read.  No rows give no rows.
    """
    spark = docs.sparkSession
    values = [F.col(c) for c in FIELDS]
    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    hit = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False)) & F.col("n_chars").isNotNull()
    # The number tells equal rows apart, so a sort can split any run of them.
    rows = staged(
        docs.select(
            "doc_id", "lang", row_digest(values).alias("digest"), F.when(hit, row_digest(changed)).alias("changed"),
            F.monotonically_increasing_id().alias("copy"),
        ),
        "leaves",
    )
    leaves = numbered(rows, ["lang"], ["doc_id", "digest", "copy"]).drop("copy")
    proven, roots = with_proofs(leaves, block_bits)
    langs = staged(roots.select(F.col("tree").alias("group"), F.col("root").alias("digest")), "roots")
    top, root = with_proofs(numbered(langs, [], ["group"]), block_bits)
    whole = root.first()  # one row, or none without documents
    top = staged(
        top.select(
            F.col("group").alias("tree"), F.col("digest").alias("subroot"), F.col("pos").alias("top_pos"),
            F.col("n").alias("top_n"), F.col("seg").alias("top_seg"), F.lit(whole.root if whole else bytearray()).alias("root"),
        ),
        "top",
    )
    found = proven.join(top, "tree").withColumn("used", F.lower(F.hex(F.coalesce("changed", "digest"))))
    found = found.withColumn("folded_subroot", F.expr(folded("used", "seg", "pos", "n")))
    found = found.withColumn("folded_root", F.expr(folded("folded_subroot", "top_seg", "top_pos", "top_n")))
    return found.select(
        "doc_id", "lang", hex_text("digest").alias("leaf"), hex_text("subroot").alias("subroot"), hex_text("root").alias("root"),
        F.sha2(F.lower(F.hex(F.concat("seg", "top_seg"))), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == hex_text("root")).alias("verified"),
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return manifest(docs, tampered=crc_class(F.col("doc_id"), 7) == 0).drop("lang")


#: Levels as lists, so a level is one row a language.
OP13_SQL = """
WITH RECURSIVE rows AS (
  SELECT doc_id, lang, n_chars,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    list_reduce(
      list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, strlen(doc_id::VARCHAR) + 1),
        lambda i: [ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, e: xor(xor(c, e) >> 1, (CASE WHEN xor(c, e) & 1 = 1 THEN 3988292384 ELSE 0 END)::BIGINT)
    ) AS state
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen((CASE WHEN doc_id IS NOT NULL AND xor(state, 4294967295) % 7 = 0 THEN n_chars + 1 ELSE n_chars END)::VARCHAR) || ':'
      || (CASE WHEN doc_id IS NOT NULL AND xor(state, 4294967295) % 7 = 0 THEN n_chars + 1 ELSE n_chars END), '-') || tail) AS used FROM rows)),
levels AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS hs FROM leaves GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(0, (len(hs) + 1) // 2), lambda i: sha256(hs[2 * i + 1] || coalesce(hs[2 * i + 2], '')))
  FROM levels WHERE len(hs) > 1),
subroots AS (SELECT lang, hs[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM levels WHERE len(hs) = 1),
tops AS (
  SELECT 0 AS level, list(subroot ORDER BY pos) AS hs FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range(0, (len(hs) + 1) // 2), lambda i: sha256(hs[2 * i + 1] || coalesce(hs[2 * i + 2], '')))
  FROM tops WHERE len(hs) > 1),
steps AS (
  SELECT l.lang, l.pos, v.level, (l.pos >> v.level) & 1 AS odd, coalesce(v.hs[xor(l.pos >> v.level, 1) + 1], '') AS sibling
  FROM leaves l JOIN levels v ON l.lang IS NOT DISTINCT FROM v.lang AND len(v.hs) > 1),
proofs AS (SELECT lang, pos, list(sibling ORDER BY level) AS siblings, list(odd ORDER BY level) AS odds FROM steps GROUP BY lang, pos),
top_steps AS (
  SELECT s.lang, t.level, (s.pos >> t.level) & 1 AS odd, coalesce(t.hs[xor(s.pos >> t.level, 1) + 1], '') AS sibling
  FROM subroots s JOIN tops t ON len(t.hs) > 1),
top_proofs AS (SELECT lang, list(sibling ORDER BY level) AS siblings, list(odd ORDER BY level) AS odds FROM top_steps GROUP BY lang),
paths AS (
  SELECT l.doc_id, l.leaf, l.used, s.subroot, (SELECT hs[1] FROM tops WHERE len(hs) = 1) AS root,
    list_concat(coalesce(p.siblings, []), coalesce(t.siblings, [])) AS siblings, list_concat(coalesce(p.odds, []), coalesce(t.odds, [])) AS odds
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
  LEFT JOIN proofs p ON l.lang IS NOT DISTINCT FROM p.lang AND l.pos = p.pos LEFT JOIN top_proofs t ON l.lang IS NOT DISTINCT FROM t.lang),
checked AS (
  SELECT *, list_reduce(
    list_prepend(used, list_transform(range(1, len(siblings) + 1), lambda i: odds[i] || siblings[i])),
    lambda h, s: sha256(CASE WHEN s[1] = '1' THEN s[2:] || h ELSE h || s[2:] END)) AS folded_root
  FROM paths)
SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_prepend('', siblings), 'string_agg', '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM checked
"""
