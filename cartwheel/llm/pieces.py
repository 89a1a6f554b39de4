"""SentencePiece encoding by forward filtering and backward sampling, and decoding.

Method.  The pieces of a text form a lattice.  A forward pass sums the weights
of all ways to reach a position; a backward pass then draws arcs from the end,
each with its share of the sum, which samples a whole segmentation from the
exact distribution over all of them.  Random numbers come from a counter hashed
with the row's key, so a row is always cut the same way, in whichever
partition, order or run.

No piece of the vocabulary holds the blank mark after another character, nor a
line feed, so a lattice falls apart at the start of each word.  The forward pass is done once
for each different word and kept; the backward pass of a text runs for all its
words at once in numpy.  (Where a vocabulary has such pieces, whole texts are
one lattice.)

The vocabulary is a merge list, not a unigram model.  A piece's weight is
therefore taken from its rank by Zipf's law, sharpened by ``alpha``.
Characters without a piece are spelled in byte pieces, so decoding gives back
every text byte for byte.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import map_batches, mix, table

#: Vocabulary file, the same place on all executors.  A parameter everywhere.
MODEL = os.environ.get("CARTWHEEL_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
ALPHA = 2.0
SEED = 13
BLANK = "▁"
#: Stands for a blank mark in the text itself; no text can hold it.
OWN_MARK = "\ud800"
#: Lattice arcs remembered before words met only once are forgotten.
KEPT_ARCS = 4_000_000


class Vocabulary:
    """Pieces of a SentencePiece model with weights, for lattices of words."""

    def __init__(self, model: str, alpha: float) -> None:
        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        size = processor.get_piece_size()
        self.ids: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.spelled: list[bytes] = [b""] * size
        rank = 0
        log_weight = np.zeros(size)
        for i in range(size):
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.spelled[i] = bytes([value])
            elif not (processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)):
                rank += 1
                self.ids[piece] = i
                self.spelled[i] = piece.replace(BLANK, " ").encode()
                log_weight[i] = -alpha * np.log(rank + 2.7)
        self.log_weight = log_weight
        self.byte_weight = -alpha * np.log(rank + 2.7) - 10.0
        self.longest = max(map(len, self.ids), default=1)
        self.cut: re.Pattern | None = None
        if not any(BLANK in p.lstrip(BLANK) for p in self.ids):
            lines = any("\n" in p for p in self.ids)
            self.cut = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+" if lines else f"\n|{BLANK}*[^{BLANK}\n]+|{BLANK}+")
        # Hash of each prefix of a piece, sorted, and the piece it is (or -1).
        prefixes: dict[str, int] = {}
        for piece, i in self.ids.items():
            for n in range(1, len(piece)):
                prefixes.setdefault(piece[:n], -1)
            prefixes[piece] = i
        texts = list(prefixes)
        hashes = np.zeros(len(texts), np.uint64)
        for n in range(self.longest):
            rows = [k for k, x in enumerate(texts) if len(x) > n]
            hashes[rows] = _extended(hashes[rows], np.array([ord(texts[k][n]) for k in rows], np.uint64))
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two prefixes share a hash")
        order = np.argsort(hashes)
        self.prefix_hash = hashes[order]
        self.prefix_piece = np.array([prefixes[x] for x in texts], np.int32)[order]


def _extended(hashes: np.ndarray, characters: np.ndarray) -> np.ndarray:
    """Hash of a text longer by one character."""
    return hashes * np.uint64(0xD1B54A32D192ED03) + mix(characters + np.uint64(1))


def _ranges(ends: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers ``end - size`` to ``end - 1`` of each range in a row; the sizes."""
    return np.arange(int(sizes.sum())) + np.repeat(ends - np.cumsum(sizes), sizes), sizes


@lru_cache(maxsize=2)
def vocabulary(model: str, alpha: float) -> Vocabulary:
    return Vocabulary(model, alpha)


class Lattices:
    """Forward passes of the words met so far, laid out for the backward pass.

    Every character of a word is a node; from ``first_arc`` of the node on,
    ``share`` holds the running share of the arcs that end there, up to 1.
    """

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab
        self.reset()

    def reset(self) -> None:
        self.last_node: dict[str, int] = {}
        self.nodes = self.arcs = 0
        self.first_arc = np.empty(4096, np.int32)
        self.share = np.empty(4096)
        self.arc_piece = np.empty(4096, np.int32)
        self.arc_from = np.empty(4096, np.int32)  # node the arc comes from, -1 for the start
        self.met_again = np.zeros(4096, bool)  # of a word's last node

    def ends_of(self, words: list[str]) -> np.ndarray:
        """Last node of each word, after adding those not met before."""
        if self.arcs > KEPT_ARCS:
            self._forget()
        known, before = self.last_node, self.nodes
        fresh = [w for w in dict.fromkeys(words) if w not in known]
        if fresh:
            self._add(fresh)
        ends = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        self.met_again[ends[ends < before]] = True
        return ends

    def _forget(self) -> None:
        """Keeps the words met in a later batch too, or none if these alone
        fill half the memory.  A kept word must be met again to stay again."""
        kept = [w for w, end in self.last_node.items() if self.met_again[end]]
        ends = np.fromiter(map(self.last_node.__getitem__, kept), np.int64, len(kept))
        nodes, sizes = _ranges(ends + 1, np.fromiter(map(len, kept), np.int64, len(kept)))
        till = np.append(self.first_arc[1 : self.nodes], self.arcs)
        widths = till[nodes] - self.first_arc[nodes]
        arcs, _ = _ranges(till[nodes], widths)
        if len(arcs) > KEPT_ARCS // 2:
            self.reset()
            return
        moved = np.repeat(np.arange(len(nodes)) - nodes, widths)
        origin = self.arc_from[arcs]
        self.share, self.arc_piece = self.share[arcs], self.arc_piece[arcs]
        self.arc_from = np.where(origin >= 0, origin + moved, -1).astype(np.int32)
        self.first_arc = (np.cumsum(widths) - widths).astype(np.int32)
        self.met_again = np.zeros(len(nodes), bool)
        self.last_node = dict(zip(kept, (np.cumsum(sizes) - 1).tolist(), strict=True))
        self.nodes, self.arcs = len(nodes), len(arcs)

    def _arcs(self, chars: np.ndarray, place: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, ...]:
        """All arcs as first character, last character, piece and weight.

        Piece numbers below zero stand for a character (-1 - code point) that
        is spelled in bytes.
        """
        vocab = self.vocab
        at, hashes = np.arange(len(chars)), np.zeros(len(chars), np.uint64)
        first, last, piece, bare = [], [], [], np.ones(len(chars), bool)
        for length in range(1, vocab.longest + 1):
            fits = left[at] >= length
            at, hashes = at[fits], hashes[fits]
            if not len(at):
                break
            hashes = _extended(hashes, chars[at + length - 1])
            slot = np.minimum(np.searchsorted(vocab.prefix_hash, hashes), len(vocab.prefix_hash) - 1)
            known = vocab.prefix_hash[slot] == hashes
            at, hashes, found = at[known], hashes[known], vocab.prefix_piece[slot[known]]
            whole = found >= 0
            first.append(at[whole])
            last.append(at[whole] + length - 1)
            piece.append(found[whole].astype(np.int64))
            if length == 1:
                bare[at[whole]] = False
        spelled = np.flatnonzero(bare)
        first.append(spelled)
        last.append(spelled)
        piece.append(-1 - chars[spelled].astype(np.int64))
        first, last, piece = (np.concatenate(x) for x in (first, last, piece))
        weight = np.where(piece >= 0, vocab.log_weight[np.maximum(piece, 0)], vocab.byte_weight)
        order = np.lexsort((last, place[last]))  # by place in the word, then by node
        return first[order], last[order], piece[order], weight[order]

    def _add(self, words: list[str]) -> None:
        """Forward pass of new words, all words' n-th characters at once."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        starts = np.cumsum(sizes) - sizes
        place = np.arange(len(chars)) - np.repeat(starts, sizes)
        first, last, piece, weight = self._arcs(chars, place, np.repeat(sizes, sizes) - place)
        total, share = np.zeros(len(chars)), np.empty(len(first))
        bounds = np.concatenate([[0], np.cumsum(np.bincount(place[last]))])
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            begin, end = first[lo:hi], last[lo:hi]
            value = weight[lo:hi] + np.where(place[begin] > 0, total[begin - 1], 0.0)
            heads = np.flatnonzero(np.concatenate([[True], end[1:] != end[:-1]]))
            widths = np.diff(np.concatenate([heads, [hi - lo]]))
            top = np.maximum.reduceat(value, heads)
            part = np.exp(value - np.repeat(top, widths))
            whole = np.add.reduceat(part, heads)
            total[end[heads]] = top + np.log(whole)
            # Each node's shares are summed on their own: a sum over the whole
            # batch would round by what else is in it.
            running = part / np.repeat(whole, widths)
            at, size, step = heads, widths, 1
            while len(at := at[size > step]):
                size = size[size > step]
                running[at + step] += running[at + step - 1]
                step += 1
            running = np.minimum(running, 1.0)
            running[heads + widths - 1] = 1.0
            share[lo:hi] = running
        order = np.argsort(last, kind="stable")
        till = self.arcs + len(order)
        for name, size in (("share", till), ("arc_piece", till), ("arc_from", till), ("first_arc", self.nodes + len(chars)), ("met_again", self.nodes + len(chars))):
            old = getattr(self, name)
            if size > len(old):
                setattr(self, name, np.concatenate([old, np.zeros(max(len(old) // 2, size - len(old)), old.dtype)]))
        arcs_at = np.bincount(last, minlength=len(chars))
        self.first_arc[self.nodes : self.nodes + len(chars)] = self.arcs + np.cumsum(arcs_at) - arcs_at
        origin = np.where(place[first] > 0, self.nodes + first - 1, -1)
        self.share[self.arcs : till] = share[order]
        self.arc_piece[self.arcs : till] = piece[order]
        self.arc_from[self.arcs : till] = origin[order]
        ends = self.nodes + starts + sizes - 1
        self.last_node.update(zip(words, ends.tolist(), strict=True))
        self.arcs, self.nodes = till, self.nodes + len(chars)

    def sample(self, ends: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece numbers of all words in order, and how many each word has."""
        words, at = np.arange(len(ends)), ends
        picked, owner = [], []
        while len(words):
            step = np.uint64(len(picked) * 0xD1B54A32D192ED03 % 2**64)
            draw = (mix(keys[words] + step) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            arc = self.first_arc[at]
            beyond = np.flatnonzero(self.share[arc] <= draw)
            while len(beyond):  # the last share of a node is 1, above any draw
                arc[beyond] += 1
                beyond = beyond[self.share[arc[beyond]] <= draw[beyond]]
            picked.append(self.arc_piece[arc])
            owner.append(words)
            at = self.arc_from[arc]
            alive = at >= 0
            words, at = words[alive], at[alive]
        counts = np.bincount(np.concatenate(owner), minlength=len(ends)) if owner else np.zeros(0, np.int64)
        # Arcs were drawn from the end: the first drawn is a word's last.
        slots, out = np.cumsum(counts) - 1, np.empty(int(counts.sum()), np.int64)
        for depth, (words, pieces) in enumerate(zip(owner, picked, strict=True)):
            out[slots[words] - depth] = pieces
        return out, counts


class Encoder:
    """Samples the segmentation of texts; one object a task."""

    def __init__(self, model: str = MODEL, alpha: float = ALPHA, seed: int = SEED) -> None:
        self.vocab = vocabulary(model, alpha)
        self.lattices = Lattices(self.vocab)
        self.seed = seed

    def words(self, text: str) -> list[str]:
        """The marked text, cut before each run of blank marks and around
        each line feed, as far as no piece spans these places."""
        marked = BLANK + text.replace(BLANK, OWN_MARK).replace(" ", BLANK)
        return self.vocab.cut.findall(marked) if self.vocab.cut else [marked]

    def encode(self, texts: list[bytes | None], keys: list) -> list[np.ndarray]:
        """Piece ids of each text; none for NULL and empty texts."""
        words, counts, marks = [], [], []
        for text, key in zip(texts, keys, strict=True):
            own = self.words(text.decode()) if text else []
            words += own
            counts.append(len(own))
            marks.append(int.from_bytes(hashlib.blake2b(f"{self.seed}|{key}".encode(), digest_size=8).digest(), "little"))
        counts = np.array(counts, np.int64)
        number = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
        seeds = mix(np.repeat(np.array(marks, np.uint64), counts) + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        pieces, per_word = self.lattices.sample(self.lattices.ends_of(words), seeds)
        if len(pieces) and pieces.min() < 0:
            spelled = {int(p): [self.vocab.byte_ids[b] for b in _character(-1 - int(p))] for p in np.unique(pieces[pieces < 0])}
            lengths = np.ones(len(pieces), np.int64)
            for p, ids in spelled.items():
                lengths[pieces == p] = len(ids)
            owner = np.repeat(np.arange(len(words)), per_word)
            per_word = np.bincount(owner, weights=lengths, minlength=len(words)).astype(np.int64)
            slots, out = np.cumsum(lengths) - lengths, np.repeat(pieces, lengths)
            for p, ids in spelled.items():
                for k, i in enumerate(ids):
                    out[slots[pieces == p] + k] = i
            pieces = out
        edge = np.concatenate([[0], np.cumsum(per_word)])
        cuts = np.concatenate([[0], np.cumsum(counts)])
        pieces = pieces.astype(np.int32)
        return [pieces[edge[a] : edge[b]] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _character(code: int) -> bytes:
    return BLANK.encode() if chr(code) == OWN_MARK else chr(code).encode()


def decode(ids: list[int] | np.ndarray | None, model: str = MODEL) -> bytes:
    """Text of piece ids: pieces joined, without the blank put in front."""
    if ids is None or not len(ids):
        return b""
    joined = b"".join(map(vocabulary(model, ALPHA).spelled.__getitem__, ids))
    return joined[1:]


def encode_texts(docs: DataFrame, model: str = MODEL, alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """``doc_id, pieces, n_pieces, lossless`` of each row.

    The row key is ``doc_id``: repeated rows are cut alike, and so are rows
    with NULL keys and equal texts.  NULL and empty texts have no pieces and
    decode to an empty text.  A text that holds the blank mark itself is
    spelled in byte pieces for that character, so it decodes too.
    Other columns are not read.
    """
    held: list[Encoder] = []

    def work(ids: list, texts: list) -> dict:
        if not held:
            held.append(Encoder(model, alpha, seed))
        pieces = held[0].encode(texts, ids)
        return {
            "doc_id": ids,
            "pieces": pieces,
            "n_pieces": [len(p) for p in pieces],
            "lossless": [decode(p.tolist(), model) == (t or b"") for p, t in zip(pieces, texts, strict=True)],
        }

    return map_batches(docs.select("doc_id", "text"), "doc_id bigint, pieces array<int>, n_pieces bigint, lossless boolean", work, rows=128)


def decode_texts(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, text`` of rows with ``doc_id, pieces``."""

    def work(ids: list, pieces: list) -> dict:
        return {"doc_id": ids, "text": [decode(p, model).decode() for p in pieces]}

    return map_batches(encoded.select("doc_id", "pieces"), "doc_id bigint, text string", work)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of each document; the digest is taken from the decoded text."""
    encoded = encode_texts(table(spark, sf_dir, "documents"))
    return encoded.select("doc_id", "n_pieces", "lossless", F.col("pieces").alias("piece_ids"))
