"""Repeated lines and sentences removed, the earliest occurrence kept.

Method.  A text is cut into units: each line, and each sentence of a line with
several.  Units are normalised (lower case, single blanks; symbols stay, as they
tell one formula from another) and hashed to 128 bits.  A digest's earliest
document in the order of ``doc_id`` keeps it, at its first place there; everywhere else the unit is removed and its offsets in the
original text are reported.  Sentences find passages that sit inside a line.

Sentences and lines with fewer than ``MIN_WORDS`` words are also hashed together
with the units that follow and that precede them, as many as it takes to reach
``MIN_WORDS``: every unit of a repeated run of that size lies in such a stretch.
Alone, a short sentence is left, as short phrases recur by chance, and a short
line is removed from ``LINE_WORDS`` words on.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import map_batches, table
from cartwheel.session import staged

MIN_WORDS = 8
#: Words from which on a line counts by itself.
LINE_WORDS = 3
_LINE = re.compile(r"[^\n]+")
_SENTENCE = re.compile(r"\S.*?(?:[.!?…。]+(?=\s|$)|$)\s*")
_WORD = re.compile(r"[^\W_]")


def _normal(text: str) -> tuple[str, int]:
    """Lower case with single blanks, and the number of words: what blanks
    divide and holds a letter or digit."""
    tokens = text.lower().split()
    return " ".join(tokens), sum(t[0].isalnum() or _WORD.search(t) is not None for t in tokens)


def units(text: str, min_words: int = MIN_WORDS, line_words: int = LINE_WORDS) -> list[tuple[bytes, int, int]]:
    """``digest, start, end`` of the units and stretches of short ones, by
    start, the longer first.  A unit takes the white space behind it along."""
    found: dict[tuple[int, int], bytes] = {}
    atoms: list[tuple[str, int, int, int]] = []  # sentences and lines of one: normal form, words, place
    for line in _LINE.finditer(text):
        normal, words = _normal(line.group())
        if not words:
            continue
        start, end = line.span()
        stop = end + (end < len(text))
        if words >= min(line_words, min_words):
            found[start, stop] = _digest(normal)
        parts = list(_SENTENCE.finditer(text, start, end))
        if len(parts) < 2:
            atoms.append((normal, words, start, stop))
            continue
        for part in parts:
            normal, words = _normal(part.group())
            if words:
                atoms.append((normal, words, part.start(), stop if part.end() == end else part.end()))
                if words >= min_words:
                    found[part.span()] = _digest(normal)
    for i, (_, words, _, _) in enumerate(atoms):
        if words < min_words:
            for step in (1, -1):
                first = last = i
                size = words
                while size < min_words and 0 <= (k := (last + 1 if step > 0 else first - 1)) < len(atoms):
                    first, last, size = min(first, k), max(last, k), size + atoms[k][1]
                place = (atoms[first][2], atoms[last][3])
                if size >= min_words and place not in found:
                    found[place] = _digest(" ".join(a[0] for a in atoms[first : last + 1]))
    return [(digest, *place) for place, digest in sorted(found.items(), key=lambda x: (x[0][0], -x[0][1]))]


def _digest(normal: str) -> bytes:
    return hashlib.blake2b(normal.encode(), digest_size=16).digest()


def without(text: str, foreign: set[bytes], min_words: int = MIN_WORDS, line_words: int = LINE_WORDS) -> tuple[str, list[tuple[int, int]]]:
    """Text without the units in ``foreign`` and without its own repeats, and
    the removed stretches as offsets in the original text.

    Stretches that touch are reported as one.  A repeat begins behind the end
    of the first occurrence.
    """
    seen: dict[bytes, int] = {}
    gone: list[list[int]] = []
    for digest, start, end in units(text, min_words, line_words):
        if digest in foreign or seen.setdefault(digest, end) <= start:
            if gone and start <= gone[-1][1]:
                gone[-1][1] = max(gone[-1][1], end)
            else:
                gone.append([start, end])
    kept, at = [], 0
    for start, end in gone:
        kept.append(text[at:start])
        at = end
    kept.append(text[at:])
    return "".join(kept), [(a, b) for a, b in gone]


def drop_repeats(docs: DataFrame, min_words: int = MIN_WORDS, line_words: int = LINE_WORDS) -> DataFrame:
    """``doc_id, text, removed, n_removed_chars`` of each row.

    ``removed`` lists the stretches ``start, end`` (code points, end excluded)
    of the original text.  Rows that share a doc_id are one document: what
    one of them holds is not foreign to another.  Rows without a doc_id rank
    last, each a document of its own, in the order they are stored.  NULL
    texts stay NULL, empty ones empty.  Texts are read whole.  Other columns
    are not read.
    """
    rows = docs.select("doc_id", "text")
    # Their numbers must be the same in both passes, so they are written down.
    nameless = staged(
        rows.where("doc_id IS NULL").select(F.lit(True).alias("late"), F.monotonically_increasing_id().alias("rank"), "doc_id", "text"), "nameless"
    )
    named = rows.where("doc_id IS NOT NULL").select(F.lit(False).alias("late"), F.col("doc_id").cast("bigint").alias("rank"), "doc_id", "text")
    ranked = named.unionByName(nameless)

    def cut(late: list, ranks: list, texts: list) -> dict:
        own = [list({u[0] for u in units(t.decode(), min_words, line_words)}) if t else [] for t in texts]
        return {"late": late, "rank": ranks, "digests": own}

    held = map_batches(ranked.select("late", "rank", "text"), "late boolean, rank bigint, digests array<binary>", cut)
    spread = staged(held.select("late", "rank", F.explode("digests").alias("digest")), "units")
    # Counted before the shuffle: a unit of a third of all documents is one
    # row a task here, and meets the join below, which Spark splits.
    by_id, by_place = F.when(~F.col("late"), F.col("rank")), F.when(F.col("late"), F.col("rank"))
    firsts = (
        spread.groupBy("digest")
        .agg(
            F.min(by_id).alias("first"), F.max(by_id).alias("last"),
            F.min(by_place).alias("first_late"), F.max(by_place).alias("last_late"),
        )
        .where("last > first OR last_late > first_late OR (first IS NOT NULL AND first_late IS NOT NULL)")
    )
    foreign = (
        spread.join(firsts.select("digest", "first", "first_late"), "digest")
        .where("CASE WHEN late AND first IS NULL THEN rank > first_late ELSE late OR rank > first END")
        .groupBy("late", "rank")
        .agg(F.collect_set("digest").alias("foreign"))
    )

    def strip(ids: list, texts: list, foreign: list) -> dict:
        out: dict = {"doc_id": ids, "text": [], "removed": [], "n_removed_chars": []}
        for text, others in zip(texts, foreign, strict=True):
            kept, gone = without(text.decode(), set(others or ()), min_words, line_words) if text else (text, [])
            out["text"].append(kept.decode() if isinstance(kept, bytes) else kept)
            out["removed"].append([{"start": a, "end": b} for a, b in gone])
            out["n_removed_chars"].append(sum(b - a for a, b in gone))
        return out

    return map_batches(
        ranked.join(foreign, ["late", "rank"], "left").select("doc_id", "text", "foreign"),
        "doc_id bigint, text string, removed array<struct<start:int,end:int>>, n_removed_chars bigint",
        strip,
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents"))
