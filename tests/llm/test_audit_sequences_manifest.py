"""Divergence audit, sequence files and Merkle manifest against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction
from math import floor

import duckdb
import numpy as np
import pytest
from pyarrow import fs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from cartwheel.llm import divergence, manifest, sequence_files
from cartwheel.llm.common import crc_class

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, rank int, shard string, pos string"


def rows_of(spark, lines):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*line, 1, "x", "y") for line in lines], DOCS)


def awkward():
    draw = random.Random(3)
    words = ["the", "The", "tea", "cup", "éa", "ÉA", "naïve", "x1y", "日本", "a-b", "I'll", "zz"]
    lines = []
    for i in range(60):
        text = " ".join(draw.choice(words) for _ in range(draw.randint(0, 30)))
        lines.append((i, text, draw.choice(["en", "fr", "en", None, ""]), draw.choice(["s0", "s0", "s1", "é", None, ""]), len(text)))
    lines += [(60, None, "en", "s0", None), (61, "", "de", "s9", 0), (62, "12 !!", "de", "s1", 5), (None, "tea", "en", "s1", 3)]
    lines += [(None, "tea", "en", "s1", 3), (None, None, None, None, None), (5, "tea cup", "en", "s1", 7), (5, "tea cup", "en", "s1", 7)]
    lines += [(70, "tea " * 20000, "en", "s0", 80000), (71, "b" * 5000 + "#" * 300, "xx", "only", 1), (2**62, "end", "zz", "one", 3)]
    return lines


@pytest.fixture(scope="module")
def docs(spark):
    return rows_of(spark, awkward()).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return rows_of(spark, [])


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Divergence audit.


def brute_audit(lines, min_docs=3, top=200):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups, in_docs = {}, {}
    for _, text, lang, source, _ in lines:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        groups.setdefault((lang or "", source or ""), Counter()).update(terms)
        in_docs.setdefault(lang or "", Counter()).update(set(terms))
    kept = {lang: sorted(t for t, n in found.items() if n >= min_docs) for lang, found in in_docs.items()}

    def shares(counts, terms):
        total = sum(counts[t] for t in terms)
        return {t: 1 + floor(Fraction(10**9 * (counts[t] + 1), total + len(terms))) for t in terms}

    def price(p, q):
        return floor(Fraction((p - q) ** 2, q))

    out = []
    for (lang, source), counts in groups.items():
        terms = kept[lang]
        own = shares(counts, terms)
        whole = shares(sum((c for (one, _), c in groups.items() if one == lang), Counter()), terms)
        parts = {"pair": [], "term": []}
        for (one, other), theirs in groups.items():
            if one == lang and other != source:
                q = shares(theirs, terms)
                parts["pair"].append((sum(price(own[t], q[t]) for t in terms), other))
        parts["term"] = [(price(own[t], whole[t]), t) for t in terms if counts[t] and own[t] > whole[t]]
        for part, found in parts.items():
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
            limit = top if part == "term" else None
            out += [(lang, source, part, item, value, rank) for rank, (value, item) in enumerate(ranked[:limit], 1)]
    return sorted(out, key=repr)


def test_audit_equals_brute_force(docs):
    assert collected(divergence.audit(docs)) == brute_audit(awkward())


def test_audit_in_many_blocks_and_chunks(docs):
    found = divergence.audit(docs, min_docs=1, top=3, held_bytes=50, block_terms=2, pair_chunk=1)
    assert collected(found) == brute_audit(awkward(), 1, 3)


def test_audit_of_nothing(empty, spark):
    assert divergence.audit(empty).collect() == []
    alone = rows_of(spark, [(1, "a b", "en", "s", 3), (2, None, "en", "t", 0)])
    assert collected(divergence.audit(alone)) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_block_distances_equal_plain_sums():
    draw = np.random.default_rng(5)
    for terms in (1, 2, 3, 17, 64):
        counts = draw.poisson(0.7, (9, terms)).astype(np.int64)
        counts[2] = counts[5] = 0
        counts[0, 0] = 10**13  # beyond 64 bits once multiplied
        totals = [int(n) for n in counts.sum(1)]
        p = [[1 + 10**9 * (int(n) + 1) // (total + 100) for n in row] for row, total in zip(counts, totals)]
        want = {(a, b): sum((x - y) ** 2 // y for x, y in zip(p[a], p[b])) for a in range(9) for b in range(9) if a != b}
        found = list(divergence.block_distances(counts, totals, 100, list(range(9))))
        assert len(found) == 72 and {(a, b): v for a, b, v in found} == want


def test_equal_subtrees_are_one_node():
    counts = np.array([[1, 2, 1, 2], [1, 2, 0, 0], [0, 0, 0, 0]])
    roots, levels, values = divergence._consed(counts, 4)
    # (1,2) and (0,0) are the only pairs, whatever their place and group.
    assert [len(left) for left, _ in levels] == [2, 3] and values.tolist() == [0, 1, 2] and len(set(roots)) == 3


def test_terms_of_bytes_are_terms_of_characters():
    text = "Ünï-Ab_cD\x00é[x]{y}~z 0a9 日本語 \x7fİ"
    want = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate({c: c + 32 for c in range(65, 91)}))
    assert [t.decode() for t in divergence.terms_of(text.encode())] == want


# Sequence files.


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(sequence_files.default_vocabulary())


def brute_sequences(lines, tokenizer):
    def order(line):
        digest = hashlib.sha256(line[1].encode()).digest() if line[1] is not None else b""
        return (line[0] is not None, line[0] or 0, line[1] is not None, digest)

    out, start = [], 0
    for line in sorted(lines, key=order):
        ids = np.array([*tokenizer.encode(line[1] or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((line[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_sequences_equal_brute_force(docs, tokenizer):
    assert collected(sequence_files.token_sequences(docs)) == brute_sequences(awkward(), tokenizer)


def test_sequences_in_small_batches(docs, tokenizer):
    assert collected(sequence_files.token_sequences(docs, length=8, rows=2, doc_rows=3)) == brute_sequences(awkward(), tokenizer)


def test_sequences_of_nothing(empty):
    assert sequence_files.token_sequences(empty).collect() == []


def test_random_access_without_a_copy(spark, folder, tokenizer):
    lines = [(i, f"some words of text number {i} # {i}", "en", "s", 1) for i in range(40)]
    shards = sequence_files.write_shards(rows_of(spark, lines).coalesce(1), folder, length=16, rows=4).collect()
    assert sum(s.n_docs for s in shards) == 40
    stream = [t for i in range(40) for t in [*tokenizer.encode(lines[i][1], add_special_tokens=False).ids, 2]]
    first = 0
    for shard in sorted(shards, key=lambda s: s.shard):
        file = sequence_files.TokenFile(fs.LocalFileSystem(), shard.tokens)
        mine = stream[first : first + shard.n_tokens]
        assert shard.n_sequences == -(-shard.n_tokens // 16)
        for number in (shard.n_sequences - 1, 0, shard.n_sequences // 2):
            ids, mask = file.sequence(number)
            want = mine[16 * number : 16 * number + 16]
            assert len(ids) == len(mask) == 16 and ids[: len(want)].tolist() == want and ids[len(want) :].sum() == 0
            assert mask.to_pylist() == [True] * len(want) + [False] * (16 - len(want))
            assert not ids.flags.owndata and not ids.flags.writeable and ids.dtype == np.uint16
        assert np.concatenate(list(file.stretch(5, 100)))[:100].tolist() == mine[5:105]
        first += shard.n_tokens
        file.close()


def test_pieces_equal_the_tokenizer(tokenizer, monkeypatch):
    draw = random.Random(1)
    signs = "aA'sStT ß×é É\n\t\x0b\x1f0129.,!?-ÀÿŸ<|>µ²́ſKİ日🙂"
    texts = ["", " ", "I'll don't  A'S ΟΔΟΣ.", "<|endoftext|>x", "a\x1cb\x00c d e", "é ́x", "'S we're'd", "a" * 3000]
    texts += ["".join(draw.choice(signs) for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    monkeypatch.setattr(sequence_files, "PIECE_CHARS", 12)
    encoder = sequence_files.WordEncoder(sequence_files.default_vocabulary(), 2, remembered=50)
    for text in texts:
        ids = np.frombuffer(b"".join(encoder.pieces(text)), encoder.kind).tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_another_kind_of_vocabulary_is_encoded_at_once(tokenizer):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = sequence_files.WordEncoder(path, 2)
    text = "Hello  world's\nend"
    assert not encoder.by_word
    ids = np.frombuffer(b"".join(encoder.pieces(text)), encoder.kind).tolist()
    assert ids == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


# Merkle manifest.


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(line, more=0):
    doc_id, text, lang, source, n = line
    values = [doc_id, source, lang, None if n is None else n + more, text]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def brute_tree(leaves):
    """Root, and per leaf the list of (sibling or None, is right child)."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for path, i in zip(paths, range(len(leaves))):
            p = at[i]
            path.append((level[p ^ 1] if p ^ 1 < len(level) else None, p & 1))
            at[i] = p >> 1
        level = [digest(*level[i : i + 2]) for i in range(0, len(level), 2)]
    return level[0], paths


def folded(start, path):
    for sibling, right in path:
        start = digest(*([start] if sibling is None else [sibling, start] if right else [start, sibling]))
    return start


def brute_manifest(lines):
    by_lang = {}
    for line in lines:
        by_lang.setdefault(line[2], []).append(line)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        members = sorted(by_lang[lang], key=lambda x: (x[0] is not None, x[0] or 0, brute_leaf(x)))
        trees[lang] = (members, *brute_tree([brute_leaf(m) for m in members]))
    root, tops = brute_tree([trees[lang][1] for lang in langs])
    out = []
    for lang, top in zip(langs, tops):
        members, subroot, paths = trees[lang]
        for line, path in zip(members, paths):
            hit = line[0] is not None and zlib.crc32(str(line[0]).encode()) % 7 == 0
            end = folded(brute_leaf(line, int(hit)), path + top)
            proof = digest(*[s for s, _ in path + top if s is not None])
            out.append((line[0], brute_leaf(line), subroot, root, proof, end, end == root))
    return sorted(out, key=repr)


def merkle(df, **sizes):
    return manifest.manifest(df, tampered=crc_class(F.col("doc_id"), 7) == 0, **sizes).drop("lang")


@pytest.mark.parametrize("bits", [10, 2])
def test_manifest_equals_brute_force(docs, bits):
    assert collected(merkle(docs, block_bits=bits)) == brute_manifest(awkward())


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 9, 33])
def test_manifest_of_any_size(spark, size):
    lines = [(i, f"t{i}", "en" if i % 3 else "fr", "s", 1) for i in range(size)]
    found = collected(merkle(rows_of(spark, lines)))
    assert found == brute_manifest(lines)
    assert all(r[-1] != (zlib.crc32(str(r[0]).encode()) % 7 == 0) for r in found)


def test_manifest_of_nothing_and_without_tampering(empty, docs):
    assert manifest.manifest(empty).collect() == []
    assert manifest.manifest(docs).where("NOT verified").count() == 0


def test_positions_do_not_need_one_task(spark):
    rows = spark.range(1000, numPartitions=7).selectExpr("id % 2 AS g", "id DIV 4 AS v")
    placed = manifest.numbered(rows, ["g"], ["v"]).collect()
    for group in (0, 1):
        mine = sorted((r.pos, r.v) for r in placed if r.g == group)
        assert [p for p, _ in mine] == list(range(500)) and [v for _, v in mine] == sorted(v for _, v in mine)
        assert {(r.tree, r.n) for r in placed if r.g == group} == {(500 * group, 500)}


# SQL twins on the awkward rows.


@pytest.mark.parametrize("name", ["op11_divergence_audit", "op13_merkle_manifest"])
def test_sql_on_awkward_rows(spark, docs, name, tmp_path):
    docs.drop("rank", "shard", "pos").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    df = entry.queries()[name](spark, str(tmp_path))
    found = db.execute(f"SELECT {', '.join(df.columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, found)) == sorted(repr(tuple(r)) for r in df.collect())
