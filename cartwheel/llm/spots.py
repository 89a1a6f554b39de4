"""Document fingerprints by spot signatures, in DataFrame operations only.

Method.  Common words are anchors; a signature is an anchor with the chain of
content words that follows it, other common words left out.  A document's
signatures form a set, its fingerprint is that set in hexadecimal.  Likeness is
the Jaccard similarity of two sets.  To find similar documents, sets are
partitioned by length, so that sets whose lengths alone rule out the threshold
never meet, and joined on their rarest signatures; what meets is compared in
full unless its lengths already rule it out.

A text without an anchor followed by a content word takes its chains at every
content word; one without content words is one signature of all its words.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import table
from cartwheel.session import staged

LANGUAGES = ("english", "french", "german", "spanish")
#: Content words in a chain.
CHAIN = 2
THRESHOLD = 0.75
#: Neighbouring rows of one stretch of the order of ids.
STRETCH_ROWS = 2000
MAX_STRETCHES = 1000
#: Texts of the stretches' first rows up to which they may be broadcast.
BROADCAST_CHARS = 32_000_000
_GAP = r"[^\p{L}\p{N}]+"


def anchor_words(languages: tuple[str, ...] = LANGUAGES) -> list[str]:
    """Single words of Spark's own lists."""
    return sorted({w for name in languages for w in StopWordsRemover.loadDefaultStopWords(name) if w.isalpha()})


def with_signatures(df: DataFrame, text: str, name: str, anchors: list[str], chain: int = CHAIN) -> DataFrame:
    """``df`` with ``name``: sorted distinct signatures of ``text`` as 32-bit
    numbers.

    Each word is marked by what ends it: a blank behind an anchor, a line feed
    behind a content word.  Cut at line feeds, the text falls into content
    words with the anchors in front of them, and chains are neighbours.  Every
    step is a column of its own, so that none is worked out twice.
    """
    keep = [F.col(f"`{c}`") for c in df.columns]
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), _GAP), lambda w: w != "")
    marked = F.transform(words, lambda w: F.concat(w, F.when(w.isin(anchors), F.lit(" ")).otherwise(F.lit("\n"))))
    runs = df.select("*", F.split(F.array_join(marked, ""), "\n").alias("_runs"))
    # Anchors and, last, the content word; the last run has no content word.
    parts = runs.select(*keep, F.transform("_runs", lambda r: F.split(r, " ")).alias("_parts"))
    content = parts.select(
        *keep, "_parts", F.transform(F.slice("_parts", 1, F.size("_parts") - 1), lambda p: F.element_at(p, -1)).alias("_content")
    )
    follow = F.transform("_content", lambda w: F.lit(""))
    for step in range(1, chain):
        later = F.slice("_content", step + 1, F.greatest(F.size("_content") - step, F.lit(0)))
        follow = later if chain == 2 else F.zip_with(follow, later, lambda a, b: F.concat_ws("\n", a, b))
    chained = content.select(*keep, "_parts", "_content", follow.alias("_follow"))
    anchored = F.flatten(
        F.zip_with(
            F.slice("_parts", 1, F.size("_parts") - 1),
            F.col("_follow"),
            lambda p, after: F.transform(F.slice(p, 1, F.size(p) - 1), lambda a: F.hash(a, F.element_at(p, -1), after)),
        )
    )
    found = chained.select(*keep, "_parts", "_content", "_follow", anchored.alias("_anchored"))
    joined = F.array_join(F.flatten("_parts"), " ")
    none = F.array().cast("array<int>")
    signatures = (
        F.when(F.size("_anchored") > 0, F.col("_anchored"))
        .when(F.size("_content") > 0, F.zip_with("_content", "_follow", lambda w, after: F.hash(w, after)))
        .when(joined != "", F.array(F.hash(joined)))
        .otherwise(none)
    )
    return found.select(*keep, F.sort_array(F.array_distinct(signatures)).alias(name))


def fingerprint(signatures: Column) -> Column:
    """The set as text: 8 hexadecimal digits a signature, empty for none."""
    return F.array_join(
        F.transform(signatures, lambda s: F.lpad(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""
    )


def jaccard(a: Column, b: Column, threshold: float = 0.0) -> Column:
    """Jaccard similarity; 0 where the lengths alone keep it below the
    threshold, 1 for two empty sets."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return (
        F.when(large == 0, F.lit(1.0))
        .when(small < F.lit(threshold) * large, F.lit(0.0))
        .otherwise(shared / (F.size(a) + F.size(b) - shared))
    )


def similar_documents(docs: DataFrame, threshold: float = THRESHOLD, languages: tuple[str, ...] = LANGUAGES) -> tuple[DataFrame, DataFrame]:
    """Membership ``doc_id, class_id`` (equal fingerprints, least id) and
    pairs ``a, b, likeness`` of class ids at the threshold or above.

    Texts without a word match nothing.  Lengths fall into partitions that
    grow by ``1 / threshold``; a set meets its own and the next one only.
    """
    anchors = anchor_words(languages)
    sets = staged(
        with_signatures(docs.where("doc_id IS NOT NULL").select("doc_id", "text"), "text", "sigs", anchors).drop("text"), "signature-sets"
    )
    keyed = sets.select("doc_id", "sigs", F.md5(fingerprint(F.col("sigs"))).alias("print"))
    classes = keyed.groupBy("print").agg(F.min("doc_id").alias("class_id"))
    members = keyed.select("doc_id", "print").join(classes, "print").select("doc_id", "class_id")
    reps = staged(
        sets.join(classes.select(F.col("class_id").alias("doc_id")), "doc_id", "left_semi").where(F.size("sigs") > 0).dropDuplicates(["doc_id"]),
        "representatives",
    )
    spread = reps.select("doc_id", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    counts = spread.groupBy("sig").agg(F.count(F.lit(1)).alias("held"))
    # The rarest signatures, enough that two similar sets must share one.
    ordered = (
        spread.join(counts, "sig")
        .groupBy("doc_id", "n")
        .agg(F.array_sort(F.collect_list(F.struct("held", "sig"))).alias("sigs"))
        .select("doc_id", "n", F.explode(F.slice("sigs", 1, (F.col("n") - F.ceil(F.col("n") * threshold) + 1).cast("int"))).alias("s"))
        .select("doc_id", "n", "s.sig", F.floor(F.log(F.col("n").cast("double")) / math.log(1 / threshold) + 1e-9).alias("part"))
    )
    left = ordered.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), "sig", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    right = ordered.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), "sig", "part")
    met = left.join(right, ["part", "sig"]).where(
        ((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))) & (F.col("n_a") >= threshold * F.col("n_b"))
    )
    pairs = met.select("a", "b").distinct()
    own = lambda name, sigs: reps.select(F.col("doc_id").alias(name), F.col("sigs").alias(sigs))
    rated = pairs.join(own("a", "x"), "a").join(own("b", "y"), "b").select("a", "b", jaccard(F.col("x"), F.col("y"), threshold).alias("likeness"))
    return members, rated.where(F.col("likeness") >= threshold)


def with_next(rows: DataFrame, carried: list[str]) -> DataFrame:
    """Adds ``next_<column>`` of the next row in the order of descending
    ``doc_id`` (NULL last, repeated ids by text); the last row's next is the first.

    Ids are cut into stretches at approximate quantiles; a window runs inside
    each stretch, and its last row takes the next stretch's first row by a
    join.  Where the cuts lie changes no result.
    """
    spark = rows.sparkSession
    total = rows.count()
    cuts: list[int] = []
    if total > STRETCH_ROWS:
        parts = min(MAX_STRETCHES, math.ceil(total / STRETCH_ROWS))
        cuts = sorted(set(rows.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10_000)).first()[0] or []))
    placed = rows.withColumn("stretch", F.coalesce(_place(F.col("doc_id"), cuts), F.lit(len(cuts) + 1)))
    order = "PARTITION BY stretch ORDER BY doc_id DESC NULLS LAST, text"
    inside = placed.withColumn("next", F.expr(f"lead(struct({', '.join(carried)})) OVER ({order})"))
    # The first row of each stretch, told by one id a stretch.
    tops = {r.stretch: r.top for r in placed.groupBy("stretch").agg(F.max("doc_id").alias("top")).collect()}
    if not tops:
        return inside
    present = sorted(tops)
    comes_after = {present[i - 1]: tops[s] for i, s in enumerate(present)}
    pairs = spark.createDataFrame(list(comes_after.items()), "of_stretch int, top bigint")
    named = [r.top for r in pairs.where("top IS NOT NULL").select("top").collect()]
    leads = rows.where(F.col("doc_id").isin(named)) if named else rows.limit(0)
    if None in tops.values():
        leads = leads.unionByName(rows.where("doc_id IS NULL").orderBy("text").limit(1))
    leads = leads.groupBy("doc_id").agg(F.min(F.struct(*carried)).alias("first"))
    bridge = staged(
        pairs.join(leads, pairs["top"].eqNullSafe(leads["doc_id"])).select("of_stretch", "first"), "stretch-firsts"
    )
    # At most MAX_STRETCHES + 1 rows; sent along if their texts are small too.
    weight = bridge.agg(F.sum(F.length("first.text"))).first()[0] or 0
    ends = F.broadcast(bridge) if weight <= BROADCAST_CHARS else bridge
    return inside.join(ends, F.col("stretch") == F.col("of_stretch"), "left").select(
        *rows.columns, F.coalesce("next", "first").alias("next")
    )


def _place(value: Column, cuts: list[int], base: int = 0) -> Column:
    """Stretch number: 0 for ids above all cuts, growing as ids fall."""
    top_down = sorted(cuts, reverse=True)

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value > F.lit(top_down[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))

    return F.when(value.isNotNull(), search(0, len(top_down)))


def op1_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each document, of its edited text, and their likeness
    to each other and to the next document's."""
    anchors = anchor_words()
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = with_signatures(docs, "text", "sigs", anchors)
    beside = with_next(own, ["text", "sigs"])
    size = F.length("text")
    cut = F.floor(size / 3).cast("int")
    edited = beside.withColumn("edited", F.concat(F.substr("text", F.lit(1), size - cut), F.substr("next.text", F.lit(1), cut)))
    edited = with_signatures(edited, "edited", "edited_sigs", anchors)
    return edited.select(
        "doc_id",
        size.cast("bigint").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        fingerprint(F.col("sigs")).alias("fingerprint"),
        fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        jaccard(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        jaccard(F.col("sigs"), F.col("next.sigs")).alias("near_next"),
    )
