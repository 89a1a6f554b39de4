"""Benchmark decontamination by SimHash windows, in DataFrame operations only.

Method.  Windows of three words are fingerprinted, at every third word of the
documents and at every offset of the items, so that each five-word shingle a
document shares with an item holds one document window that the item has too,
wherever either stands.  SimHash counters of a window are packed eight to a
64-bit number, so that one sum adds eight of them.  A fingerprint of 64 bits is
cut into four blocks: two fingerprints within ``RADIUS = 3`` bits agree in a
block, so the block join finds all of them.  The starts at which an item-sized
stretch holds enough of the item's windows are then verified: the weighted
Jaccard similarity (multiplicities as weights) between the item's five-word
shingles and those of the stretch.

Why nothing at the threshold is missed.  A stretch of ``m`` shingles at a
similarity of ``t`` or more to an item of ``n`` shares at least
``t / (1 + t) * (n + m)`` shingles with it.  A window lies in at most three
shingles, so the stretch holds at least a third as many of the item's windows.
Nothing is assumed about where the lost shingles are or about their order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import table
from cartwheel.session import staged

WORDS = 5
THRESHOLD = 0.75
RADIUS = 3
#: Words of a window, and of the step between the windows of a document.
SPAN = 3
#: Size up to which the items' fingerprints may be sent to every executor.
BROADCAST_ROWS = 500_000

_LOW = 0x0101010101010101
_FLAG = 0x4040404040404040
#: Words are runs of letters and digits, in lower case.
_GAP = r"[^\p{L}\p{N}]+"


def words_column(text: Column) -> Column:
    """Words of a text; empty array for NULL or no word."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _GAP), lambda w: w != "")


def _fingerprint(hashes: str, start: Column, span: int) -> list[Column]:
    """The four blocks of the ``span`` hashes from ``start`` on: a bit is set
    where two or more words set it.  A single word counts twice.

    Counter j of sum k is bit 8j + k.  It is two or more if its half, rounded
    down, is one or more; adding the missing part up to 64 raises its flag bit.
    """
    words = [F.col(hashes)[start + i] for i in range(span)] * (2 if span == 1 else 1)
    flags = []
    for k in range(8):
        total = reduce(lambda x, y: x + y, [F.shiftrightunsigned(w, k).bitwiseAND(F.lit(_LOW)) for w in words])
        flags.append((F.shiftrightunsigned(total, 1).bitwiseAND(F.lit(_LOW * 0x3F)) + F.lit(63 * _LOW)).bitwiseAND(F.lit(_FLAG)))
    return [flags[2 * j].bitwiseOR(F.shiftrightunsigned(flags[2 * j + 1], 1)).alias(f"b{j}") for j in range(4)]


def _distance(left: str, right: str) -> Column:
    return reduce(
        lambda x, y: x + y,
        [F.bit_count(F.col(f"{left}.b{j}").bitwiseXOR(F.col(f"{right}.b{j}"))) for j in range(4)],
    )


def item_table(benchmark: DataFrame) -> DataFrame:
    """``item_id, words, length, span`` of each item that has a word."""
    return (
        benchmark.select("item_id", words_column(F.col("text")).alias("words"))
        .withColumn("length", F.size("words"))
        .where("length > 0")
        # Items of fewer words than a shingle are one shingle: two words, or
        # the only one, at every place.
        .withColumn("span", F.when(F.col("length") >= WORDS, F.lit(SPAN)).otherwise(F.least(F.col("length"), F.lit(2))))
    )


def _windows(rows: DataFrame, span: int, step: int, *keep: str) -> DataFrame:
    """``keep, start, b0..b3`` of the windows of ``span`` words that begin at
    multiples of ``step``."""
    hashed = rows.select(*keep, F.transform("words", lambda w: F.xxhash64(w)).alias("hashes")).where(F.size("hashes") >= span)
    starts = hashed.select(*keep, "hashes", F.explode(F.sequence(F.lit(0), F.size("hashes") - span, F.lit(step))).alias("start"))
    return starts.select(*keep, "start", *_fingerprint("hashes", F.col("start"), span))


def item_windows(items: DataFrame, span: int) -> DataFrame:
    """Different fingerprints ``item_id, length, b0..b3`` of the items looked
    for by ``span`` words."""
    return _windows(items.where(F.col("span") == span), span, 1, "item_id", "length").drop("start").distinct()


def document_windows(docs: DataFrame, span: int) -> DataFrame:
    """``doc_id, n, start, b0..b3``: windows of a document of ``n`` words."""
    rows = docs.select("doc_id", words_column(F.col("text")).alias("words")).select("doc_id", "words", F.size("words").alias("n"))
    return _windows(rows, span, span if span == SPAN else 1, "doc_id", "n")


def _keys(side: DataFrame, *keep: str) -> DataFrame:
    """One row a fingerprint block: its number and value."""
    return side.select(*keep, *[f"b{j}" for j in range(4)], F.posexplode(F.array(*[f"b{j}" for j in range(4)])).alias("part", "key"))


def _begins(length: Column, span: int, n: Column, at: Column, threshold: float) -> Column:
    """Starts of the stretches of ``length`` words that hold as many of the
    sorted window starts ``at`` as the threshold asks for."""
    if span == SPAN:
        sizes = length - (WORDS - 1) + F.least(length - (WORDS - 1), F.greatest(n - (WORDS - 1), F.lit(1)))
        # A little less, against rounding.
        enough = F.ceil(threshold / (1 + threshold) * sizes / SPAN - 1e-9).cast("int")
    else:  # all of them
        enough = length - span + 1
    enough, reach = F.greatest(enough, F.lit(1)), length - span
    ranges = F.transform(
        F.sequence(F.lit(0), F.size(at) - enough),
        lambda i: F.when(
            at[i + enough - 1] - at[i] <= reach,
            F.sequence(F.greatest(at[i + enough - 1] - reach, F.lit(0)), at[i]),
        ).otherwise(F.array().cast("array<int>")),
    )
    return F.when(F.size(at) >= enough, F.array_distinct(F.flatten(ranges)))


def candidates(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, length, begin``: where an item may start in a
    document."""
    found = []
    for span in sorted(r.span for r in items.select("span").distinct().collect()):
        probes = staged(item_windows(items, span), "item-windows")
        left = _keys(document_windows(docs, span), "doc_id", "n", "start").alias("d")
        right = _keys(probes, "item_id", "length").alias("i")
        met = left.join(
            F.broadcast(right) if probes.count() <= BROADCAST_ROWS else right,
            (F.col("d.part") == F.col("i.part")) & (F.col("d.key") == F.col("i.key")) & (_distance("d", "i") <= RADIUS),
        )
        # Rows that share a doc_id are looked at together: more starts, none less.
        places = met.groupBy("d.doc_id", "i.item_id", "i.length").agg(
            F.min("d.n").alias("n"), F.sort_array(F.collect_set("d.start")).alias("at")
        )
        begins = _begins(F.col("length"), span, F.col("n"), F.col("at"), threshold)
        found.append(places.select("doc_id", "item_id", "length", F.explode(begins).alias("begin")))
    return reduce(DataFrame.unionByName, found)


def _shingles(words: Column) -> Column:
    """Five-word shingles in order; a shorter text is one shingle."""
    return F.when(
        F.size(words) >= WORDS,
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - WORDS + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, WORDS), " ")),
    ).otherwise(F.array(F.array_join(words, " ")))


def verified(docs: DataFrame, items: DataFrame, found: DataFrame) -> DataFrame:
    """``doc_id, item_id, begin, similarity`` of each pair's best start."""
    item_side = items.select("item_id", "length", F.transform(_shingles(F.col("words")), lambda x: F.xxhash64(x)).alias("wanted"))
    per_document = found.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "begin", "length")).alias("tries"))
    shingled = (
        docs.select("doc_id", "text")
        .join(per_document, "doc_id")
        .withColumn("words", words_column(F.col("text")))
        .select("doc_id", "tries", "words", F.size("words").alias("n"), F.transform(_shingles(F.col("words")), lambda x: F.xxhash64(x)).alias("own"))
    )
    one = shingled.select("doc_id", "words", "n", "own", F.explode("tries").alias("t")).select("doc_id", "words", "n", "own", "t.*")
    # A start is where a whole item-sized stretch fits; a shorter document
    # has the start 0 only.
    one = one.where((F.col("begin") >= 0) & (F.col("begin") <= F.greatest(F.col("n") - F.col("length"), F.lit(0))))
    # An item of few words is one shingle of its own size.
    short = F.array(F.xxhash64(F.array_join(F.slice("words", F.col("begin") + 1, F.col("length")), " ")))
    one = one.withColumn("stretch", F.when(F.col("length") < WORDS, short).otherwise(F.slice("own", F.col("begin") + 1, F.greatest(F.col("length") - WORDS + 1, F.lit(1)))))
    scored = one.select("doc_id", "item_id", "length", "begin", "stretch").join(item_side, ["item_id", "length"])
    # Multiplicities: shared weight is the sum of the smaller counts.
    both = F.array_distinct(F.array_intersect("stretch", "wanted"))
    times = lambda values, x: F.size(F.filter(values, lambda y: y == x))
    counted = F.aggregate(both, F.lit(0), lambda total, x: total + F.least(times(F.col("stretch"), x), times(F.col("wanted"), x)))
    plain = (F.size(F.array_distinct("stretch")) == F.size("stretch")) | (F.size(F.array_distinct("wanted")) == F.size("wanted"))
    shared = F.when(plain, F.size(both)).otherwise(counted)
    scored = scored.select("doc_id", "item_id", "begin", shared.alias("shared"), (F.size("stretch") + F.size("wanted")).alias("sizes"))
    rated = scored.select("doc_id", "item_id", "begin", (F.col("shared") / (F.col("sizes") - F.col("shared"))).alias("similarity"))
    return rated.groupBy("doc_id", "item_id").agg(
        F.max("similarity").alias("similarity"), F.max_by("begin", F.struct("similarity", -F.col("begin"))).alias("begin")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Hits ``doc_id, item_id, similarity, begin`` at the threshold or above.

    ``begin`` is the word at which the item starts.  NULL and empty texts of
    either table hit nothing, nor do rows without a doc_id; rows that share a
    doc_id share their hits; repeated items count once; long documents are
    read whole; other columns are not read.
    """
    items = staged(item_table(benchmark.where("item_id IS NOT NULL").dropDuplicates(["item_id", "text"])), "items")
    if items.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, similarity double, begin int")
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    found = staged(candidates(known, items, threshold), "candidates")
    return verified(known, items, found).where(F.col("similarity") >= threshold)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the items it holds; ``kept`` where there are none."""
    docs = table(spark, sf_dir, "documents")
    hits = contaminated(docs, table(spark, sf_dir, "benchmark"))
    per_document = hits.groupBy("doc_id").agg(
        F.concat_ws(",", F.transform(F.array_sort(F.collect_set("item_id")), lambda x: x.cast("string"))).alias("item_ids"),
        F.round(F.max("similarity"), 6).alias("similarity"),
    )
    return docs.select("doc_id").join(per_document, "doc_id", "left").select(
        "doc_id",
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.lit("")).alias("item_ids"),
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
        F.col("item_ids").isNull().alias("kept"),
    )


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(COALESCE(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
), i AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(COALESCE(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark
), ds AS (
  SELECT doc_id, len(w) AS n, unnest(range(0, greatest(len(w) - 4, 1))) AS p,
         unnest([array_to_string(w[k + 1:k + 5], ' ') FOR k IN range(0, greatest(len(w) - 4, 1))]) AS sh FROM d WHERE len(w) > 0
), isx AS (
  SELECT item_id, len(w) AS l, unnest(range(0, greatest(len(w) - 4, 1))) AS p,
         unnest([array_to_string(w[k + 1:k + 5], ' ') FOR k IN range(0, greatest(len(w) - 4, 1))]) AS sh FROM i WHERE len(w) > 0
), near AS (
  SELECT DISTINCT doc_id, item_id, l, n, ds.p - isx.p AS b FROM ds JOIN isx USING (sh)
), starts AS (
  SELECT DISTINCT doc_id, item_id, l, x FROM (
    SELECT doc_id, item_id, l, n, unnest(range(b - greatest((l - 4) // 7, 0), b + greatest((l - 4) // 7, 0) + 1)) AS x FROM near)
  WHERE x >= 0 AND x <= greatest(n - l, 0)
), stretch AS (
  SELECT s.doc_id, s.item_id, s.x, ds.sh, COUNT(*) AS c
  FROM starts s JOIN ds ON ds.doc_id = s.doc_id AND ds.p >= s.x AND ds.p < s.x + greatest(s.l - 4, 1) GROUP BY ALL
), wanted AS (SELECT item_id, sh, COUNT(*) AS c FROM isx GROUP BY ALL),
sizes AS (SELECT item_id, SUM(c) AS c FROM wanted GROUP BY ALL),
total AS (SELECT doc_id, item_id, x, SUM(c) AS c FROM stretch GROUP BY ALL),
shared AS (
  SELECT doc_id, item_id, x, SUM(least(s.c, w.c)) AS c FROM stretch s JOIN wanted w USING (item_id, sh) GROUP BY ALL
), hits AS (
  SELECT doc_id, item_id, MAX(CAST(h.c AS DOUBLE) / (t.c + z.c - h.c)) AS sim
  FROM shared h JOIN total t USING (doc_id, item_id, x) JOIN sizes z USING (item_id)
  GROUP BY ALL HAVING MAX(CAST(h.c AS DOUBLE) / (t.c + z.c - h.c)) >= 0.75
), per_document AS (
  SELECT doc_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS item_ids, ROUND(MAX(sim), 6) AS similarity
  FROM hits GROUP BY doc_id
)
SELECT documents.doc_id, item_ids IS NOT NULL AS contaminated, COALESCE(item_ids, '') AS item_ids,
       COALESCE(similarity, 0.0) AS similarity, item_ids IS NULL AS kept
FROM documents LEFT JOIN per_document USING (doc_id)
"""
