"""How far the word use of each source is from that of the others.

Counting.  A task counts the terms of some megabytes of text at once and hands
out sums, so a frequent term or a hot source is a few rows per task.

Trees.  A language's kept terms are dealt into blocks by a hash of their id.
Inside a block every group (source) has a segment tree over the terms: a leaf
is a count, an inner node the pair of its halves.  Nodes are hash-consed over
all groups: subtrees with equal counts are one node.  Two groups are compared
by walking their trees together from the roots.  Per pair of groups a pair of
nodes that turns up more than once is walked once, with its multiplicity, and
a pair of leaves is priced once.  Prices depend on the groups' totals, so they
are shared within a pair of groups, not between pairs.

Scale.  A block's data is bounded by ``BLOCK_TERMS`` times the sources of a
language.  Sources are compared ``PAIR_CHUNK`` at a time, each chunk its own
group, so many sources spread over many tasks.  The result itself is a row for
each ordered pair of sources of a language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import table
from cartwheel.session import staged

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
BLOCK_TERMS = 3600
PAIR_CHUNK = 16
#: Bytes of text whose terms a task counts at once.
HELD_BYTES = 16 << 20
#: Stands for a term's id in rows that describe a source.
HEAD = -1

#: Letters of ASCII in lower case and all bytes above it; the rest parts terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def _rows(groups: list[tuple], of: np.ndarray, terms: pa.Array, n: np.ndarray, n_docs: np.ndarray) -> pa.RecordBatch:
    """Sums as a batch, with a NULL term for each group so that it is known."""
    of = np.concatenate([of, np.arange(len(groups))])
    none = np.zeros(len(groups), np.int64)
    langs, sources = (pa.array([g[i].decode() for g in groups]).take(pa.array(of)) for i in (0, 1))
    words = pa.concat_arrays([terms, pa.nulls(len(groups), pa.string())])
    counts = [pa.array(np.concatenate([v, none])) for v in (n, n_docs)]
    return pa.RecordBatch.from_arrays([langs, sources, words, *counts], ["lang", "source", "term", "n", "n_docs"])


def _starts(sorted_: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(sorted_) else np.zeros(0, np.int64)


def chunk_sums(held: list[tuple[bytes, bytes, bytes]]) -> pa.RecordBatch:
    """Uses of each term, and documents that use it, by group over some
    ``(lang, source, text)``."""
    numbers: dict[tuple, int] = {}
    group = np.array([numbers.setdefault(h[:2], len(numbers)) for h in held], np.int64)
    texts = pa.array([h[2].translate(TERM_BYTES).strip() for h in held], pa.binary()).cast(pa.string())
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    terms, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    size = max(len(terms), 1)
    pairs = np.repeat(np.arange(len(held)), pc.list_value_length(split).to_numpy()) * size + codes
    pairs.sort()
    first = _starts(pairs)
    uses, pairs = np.diff(np.append(first, len(pairs))), pairs[first]
    by_group = group[pairs // size] * size + pairs % size
    order = np.argsort(by_group, kind="stable")
    by_group, uses = by_group[order], uses[order]
    first = _starts(by_group)
    n = np.add.reduceat(uses, first) if len(first) else uses
    n_docs, by_group = np.diff(np.append(first, len(by_group))), by_group[first]
    made = _rows(list(numbers), by_group // size, terms.take(pa.array(by_group % size)), n, n_docs)
    # An empty text splits into one empty term.
    return made.filter(pc.fill_null(pc.not_equal(made.column(2), ""), True))


def long_text_sums(lang: bytes, source: bytes, text: bytes, piece: int) -> pa.RecordBatch:
    """The same for one text, a piece at a time, so that only its different
    terms are held at once."""
    found, start = Counter(), 0
    while start < len(text):
        end = start + piece
        # A piece ends between two terms.
        while end < len(text) and TERM_BYTES[text[end]] != 32:
            end += 1
        found.update(terms_of(text[start:end]))
        start = end
    n = np.fromiter(found.values(), np.int64, len(found))
    terms = pa.array(list(found), pa.binary()).cast(pa.string())
    return _rows([(lang, source)], np.zeros(len(found), np.int64), terms, n, np.ones(len(found), np.int64))


def count_terms(docs: DataFrame, held_bytes: int = HELD_BYTES) -> DataFrame:
    """``lang, source, term, n, n_docs``, partial sums; the NULL term stands
    for a group, so that one without terms is known."""
    texts = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.cast(pa.binary()) for c in batch.columns)):
                lang, source, text = (value.as_py() for value in row)
                if len(text) > held_bytes:
                    yield long_text_sums(lang, source, text, held_bytes)
                    continue
                held.append((lang, source, text))
                size += len(text) + 1
                if size > held_bytes:
                    yield chunk_sums(held)
                    held, size = [], 0
        if held:
            yield chunk_sums(held)

    return texts.mapInArrow(run, "lang string, source string, term string, n bigint, n_docs bigint")


def share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (n + 1) / (total + terms))``, exact for any counts."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return F.call_function("div", above, (total + terms).cast("decimal(20,0)")) + 1


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _consed(counts: np.ndarray, width: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Trees over the rows of ``counts``: each row's root, per level (leaves'
    parents first) the halves of each node, and the leaves' counts (-1 for
    places behind the last term)."""
    padded = np.full((len(counts), width), -1, np.int64)
    padded[:, : counts.shape[1]] = counts
    values, nodes = np.unique(padded, return_inverse=True)
    nodes, levels = nodes.reshape(padded.shape), []
    while nodes.shape[1] > 1:
        size = int(nodes.max()) + 1
        pairs, again = np.unique(nodes[:, ::2] * size + nodes[:, 1::2], return_inverse=True)
        levels.append((pairs // size, pairs % size))
        nodes = again.reshape(len(counts), -1)
    return nodes[:, 0], levels, values


def _merged(other: np.ndarray, a: np.ndarray, b: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
    """Equal (other, a, b) as one, with the sum of their multiplicities."""
    size_a, size_b = int(a.max()) + 1, int(b.max()) + 1
    key = (other * size_a + a) * size_b + b
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    kept, times = order[first], np.add.reduceat(times[order], first)
    return other[kept], a[kept], b[kept], times


def block_distances(counts: np.ndarray, totals: list[int], terms: int, chosen: list[int]) -> Iterator[tuple[int, int, int]]:
    """``(group, other, distance)`` over one block for pairs of groups whose
    lower number is among ``chosen``, in both directions.

    ``counts`` has a row per group and a column per term; ``totals`` are the
    groups' sums over all blocks and ``terms`` the language's kept terms.
    """
    groups, width = len(counts), 1 << max(counts.shape[1] - 1, 0).bit_length()
    roots, levels, values = _consed(counts, width)
    # Shares as Python numbers first: the product leaves 64 bits for counts
    # above nine billion.  The places behind the last term get share 1 in
    # every group, so their distance is 0.  A group has no count above its total.
    shares = np.array(
        [[1 if v < 0 else 1 + SCALE * (min(v, total) + 1) // (total + terms) for v in values.tolist()] for total in totals], np.int64
    )
    for group in chosen:
        others = np.arange(group + 1, groups)
        if not len(others):
            continue
        at = (others, np.full(len(others), roots[group]), roots[others], np.ones(len(others), np.int64))
        for left, right in reversed(levels):
            other, a, b, times = at
            at = _merged(
                np.concatenate([other, other]), np.concatenate([left[a], right[a]]),
                np.concatenate([left[b], right[b]]), np.concatenate([times, times]),
            )
        other, a, b, times = at
        p, q = shares[group][a], shares[other, b]
        apart = (p - q) ** 2
        there, back = np.zeros(groups, np.int64), np.zeros(groups, np.int64)
        np.add.at(there, other, apart // q * times)
        np.add.at(back, other, apart // p * times)
        for o in others.tolist():
            yield group, o, int(there[o])
            yield o, group, int(back[o])


def _block(rows: pd.DataFrame, pair_chunk: int) -> pd.DataFrame:
    """One group of ``pair_distances``: a block's counts, and a row with the
    id ``HEAD`` for every source of the language."""
    sources = rows[rows.id == HEAD].sort_values("number")
    seen = rows[rows.id != HEAD]
    terms = seen[["id", "lang_n"]].drop_duplicates("id").sort_values(["lang_n", "id"], ascending=[False, True])
    counts = np.zeros((len(sources), len(terms)), np.int64)
    column = pd.Series(np.arange(len(terms)), index=terms.id)
    counts[seen.number.to_numpy(np.int64), column[seen.id].to_numpy()] = seen.n.to_numpy(np.int64)
    chunk = int(rows.chunk.iloc[0])
    chosen = list(range(chunk * pair_chunk, min((chunk + 1) * pair_chunk, len(sources))))
    found = block_distances(counts, sources.total.astype("int64").tolist(), int(sources.terms.iloc[0]), chosen)
    made = pd.DataFrame(found, columns=["number", "other", "value"])
    made.insert(0, "lang", rows.lang.iloc[0])
    return made


def pair_distances(counts: DataFrame, groups: DataFrame, block_terms: int = BLOCK_TERMS, pair_chunk: int = PAIR_CHUNK) -> DataFrame:
    """``lang, number, other, value`` for each ordered pair of sources of a
    language with kept terms."""
    blocks = F.ceil(F.col("terms") / block_terms)
    chunks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("sources") - 1) / pair_chunk))).alias("chunk")
    zero = F.lit(0).cast("bigint")
    known = groups.where("terms > 0 AND sources > 1")
    facts = counts.join(known.select("lang", "source", "number", "terms", "sources"), ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("id"), blocks).alias("block"), chunks, "number", "id", "lang_n", "n",
        zero.alias("total"), zero.alias("terms"),
    )
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("block")
    heads = known.select("lang", "number", "total", "terms", "sources", every).select(
        "lang", "block", chunks, "number", F.lit(HEAD).cast("bigint").alias("id"), zero.alias("lang_n"), zero.alias("n"), "total", "terms"
    )
    parts = facts.unionByName(heads).groupBy("lang", "block", "chunk")
    found = parts.applyInPandas(lambda rows: _block(rows, pair_chunk), "lang string, number bigint, other bigint, value bigint")
    return found.groupBy("lang", "number", "other").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top: int = TOP_TERMS,
    held_bytes: int = HELD_BYTES,
    block_terms: int = BLOCK_TERMS,
    pair_chunk: int = PAIR_CHUNK,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: every source's distance to
    each other source of its language (part ``pair``), and the ``top`` terms
    that it uses more than its language does (part ``term``).

    NULL texts, languages and sources are empty ones; repeated rows count
    each; ties are ranked by the item's UTF-8 bytes; other columns are not
    read; the last three parameters size tasks and do not change the result;
    a language without kept terms has distances of 0; no rows give none.
    """
    sums = staged(
        count_terms(docs, held_bytes).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")), "terms"
    )
    kept = sums.where("term IS NOT NULL").groupBy("lang", "term").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("uses")
    ).where(F.col("n_docs") >= min_docs)
    # The id is stored, so every reader sees the same one.
    kept = staged(kept.select("lang", "term", "lang_n", "uses", F.monotonically_increasing_id().alias("id")), "kept")
    counts = kept.select("lang", "term", "id", "lang_n", F.inline("uses"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = Window.partitionBy("lang")
    groups = staged(
        sums.select("lang", "source").distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
        .na.fill(0, ["terms", "lang_total", "total"])
        .withColumn("number", (F.row_number().over(of_lang.orderBy("source")) - 1).cast("bigint"))
        .withColumn("sources", F.count(F.lit(1)).over(of_lang)),
        "groups",
    )
    other = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("other"))
    pairs = groups.select("lang", "source", "number").join(other, "lang").where("number <> other")
    pairs = pairs.join(pair_distances(counts, groups, block_terms, pair_chunk), ["lang", "number", "other"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("bigint").alias("value"))
    p, q = F.col("p"), F.col("q")
    used = counts.join(groups.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
    )
    over = used.where(p > q).select("lang", "source", "part", "item", distance(p, q).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(best).alias("rank")
    return pairs.select("*", ranked).unionByName(over.select("*", ranked).where(F.col("rank") <= top))


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (SELECT lang, source, doc, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
langs AS (SELECT lang, count(*)::HUGEINT AS terms, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source),
shares AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (t.total + l.terms) AS p,
    1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.terms) AS q
  FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
every AS (
  SELECT * FROM pairs UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank
FROM every QUALIFY part = 'pair' OR rank <= 200
"""
