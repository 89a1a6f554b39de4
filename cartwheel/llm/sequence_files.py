"""Token ids as equal-length sequences in Arrow stream files.

Format.  A shard is two files in the Arrow IPC stream format, uncompressed and
without NULLs, so every batch but the last takes the same number of bytes and
batch i lies at ``head + i * step``:

* ``<shard>.tokens.arrows``: ``ids`` and ``mask``, fixed-size lists of
  ``length`` items, ``rows`` sequences a batch.  The documents' ids stand one
  behind the other; a mask is true over ids and false over the padding that
  fills the last sequence of the shard.  Ids take two bytes where the
  vocabulary allows it, else four, a mask one bit.
* ``<shard>.docs.arrows``: ``doc_id``, ``known`` (0 for a NULL id), ``start``
  (ids before the document in this shard) and ``n_tokens``.

A reader seeks to a batch and wraps its buffers, so any sequence or document of
a memory-mapped file is reached without a copy or a scan.

Writing.  A range sort on the document id gives each task a run of documents in
order; the task streams them to one shard.  Shards are named anew by every
attempt and only those in the returned shard table count, so a task that is
repeated does no harm.

Encoding.  A vocabulary that drops white space and splits texts by ``SPLIT``
treats each piece by itself, so a text's ids are those of its pieces, and a
worker remembers the ids of pieces it has met.  Texts of plain Latin letters
are split here and only new pieces go through the tokenizer's model; all other
texts go through the whole tokenizer, a blank-separated word at a time.  With
another kind of vocabulary every text is encoded at once.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartwheel.llm.common import table
from cartwheel.session import shared_dir, staged

LENGTH = 2048
ROWS = 64
DOC_ROWS = 4096
REMEMBERED = 300_000
LONGEST_REMEMBERED = 64
#: Characters of a text that are encoded at once.
PIECE_CHARS = 1 << 20
#: The id that ends a document.  Texts may hold it too, so the document file
#: says where documents end.
END = 2

# How the vocabulary splits a normalised text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Texts in which lower case is a letter-by-letter matter, nothing composes, and
#: letters, digits and blanks are these; the same split for them.
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
PLAIN_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")


def byte_signs() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: its
    own where that can be printed, else the next one above 255."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


BYTE_SIGNS = byte_signs()

SHARDS = "shard int, tokens string, docs string, n_docs bigint, n_tokens bigint, n_sequences bigint"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Pieces(dict):
    """Ids of pieces of plain letters, encoded when first asked for."""

    def __init__(self, tokenizer: Tokenizer, kind: np.dtype, limit: int):
        self.model, self.limit = tokenizer.model, limit
        self.code = "H" if kind.itemsize == 2 else "I"

    def __missing__(self, piece: str) -> bytes:
        signs = piece if piece.isascii() else piece.encode().decode("latin-1").translate(BYTE_SIGNS)
        found = self.model.tokenize(signs)
        ids = struct.pack(f"<{len(found)}{self.code}", *[t.id for t in found])
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = ids
        return ids


class WordEncoder:
    """Ids of texts as the bytes of little-endian numbers of type ``kind``."""

    def __init__(self, vocabulary: str, end: int, remembered: int = REMEMBERED):
        # One task is one core; the library's own threads would be more.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.by_word = _splits(self.tokenizer) == SPLIT and _normalizers(self.tokenizer) == ["NFC", "Replace", "Lowercase"]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = np.dtype("<u2" if max(self.tokenizer.get_vocab_size(), end + 1) <= 1 << 16 else "<u4")
        self.remembered, self.words = remembered, {}
        self.parts = _Pieces(self.tokenizer, self.kind, remembered)

    def _encoded(self, words: Sequence[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(one.ids, self.kind).tobytes() for one in found]

    def _by_words(self, text: str) -> bytes:
        words = text.split(" ")
        new = [w for w in dict.fromkeys(words) if w not in self.words]
        if new:
            if len(self.words) + len(new) > self.remembered:
                self.words = {}
                new = list(dict.fromkeys(words))
            self.words.update(zip(new, self._encoded(new)))
        ids = b"".join([self.words[w] for w in words])
        for word in new:
            if len(word) > LONGEST_REMEMBERED:
                del self.words[word]
        return ids

    def _piece(self, text: str) -> bytes:
        if PLAIN.fullmatch(text) and not any(t in text for t in self.special):
            return b"".join(map(self.parts.__getitem__, PLAIN_SPLIT.findall(text.lower())))
        return self._by_words(text)

    def pieces(self, text: str) -> Iterator[bytes]:
        """Ids of a text, where possible a bounded stretch of it at a time."""
        if not self.by_word:
            yield from self._encoded([text])
            return
        start = 0
        while len(text) - start > PIECE_CHARS:
            cut = text.find(" ", start + PIECE_CHARS)
            if cut < 0:
                break
            yield self._piece(text[start:cut])
            start = cut + 1
        yield self._piece(text[start:])


def _rules(step: object | None) -> dict:
    """What a step of a tokenizer says about itself."""
    return json.loads(step.__getstate__()) if step is not None else {}


def _splits(tokenizer: Tokenizer) -> str | None:
    steps = _rules(tokenizer.pre_tokenizer).get("pretokenizers") or [{}]
    return (steps[0].get("pattern") or {}).get("Regex")


def _normalizers(tokenizer: Tokenizer) -> list[str]:
    return [n["type"] for n in _rules(tokenizer.normalizer).get("normalizers", [])]


@lru_cache(maxsize=2)
def encoder_of(vocabulary: str, end: int) -> WordEncoder:
    """One per worker process, so that tasks share what is remembered."""
    return WordEncoder(vocabulary, end)


class _Shard:
    """Writes one shard as documents arrive."""

    def __init__(self, store: fs.FileSystem, folder: str, kind: np.dtype, length: int, rows: int, doc_rows: int = DOC_ROWS):
        name = f"{folder}/{uuid.uuid4().hex}"
        self.kind, self.schema = kind, token_schema(kind, length)
        self.paths = (f"{name}.tokens.arrows", f"{name}.docs.arrows")
        self.length, self.rows, self.doc_rows = length, rows, doc_rows
        self.pending, self.pending_bytes, self.docs = [], 0, []
        self.n_docs = self.n_tokens = self.n_sequences = 0
        store.create_dir(folder, recursive=True)
        self.sinks = [store.open_output_stream(p) for p in self.paths]
        self.writers = [pa.ipc.new_stream(s, t) for s, t in zip(self.sinks, (self.schema, DOCS_SCHEMA))]

    def add(self, doc_id: int | None, pieces: Iterator[bytes], end: int) -> None:
        start = self.n_tokens
        for ids in pieces:
            self._append(ids)
        self._append(np.array([end], self.kind).tobytes())
        self.docs.append((doc_id or 0, int(doc_id is not None), start, self.n_tokens - start))
        self.n_docs += 1
        if len(self.docs) == self.doc_rows:
            self._write_docs()

    def _append(self, ids: bytes) -> None:
        self.pending.append(ids)
        self.pending_bytes += len(ids)
        self.n_tokens += len(ids) // self.kind.itemsize
        if self.pending_bytes >= self.kind.itemsize * self.length * self.rows:
            self._write_tokens(whole=True)

    def _write_tokens(self, whole: bool) -> None:
        ids = np.frombuffer(b"".join(self.pending), self.kind)
        size = self.length * self.rows
        full = len(ids) // size * size if whole else len(ids)
        for at in range(0, full, size):
            part = ids[at : min(at + size, full)]
            mask = np.ones(len(part), bool)
            if short := -len(part) % self.length:
                part, mask = np.pad(part, (0, short)), np.pad(mask, (0, short))
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(v), self.length) for v in (part, mask)]
            self.writers[0].write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
            self.n_sequences += len(part) // self.length
        left = ids[full:].tobytes()
        self.pending, self.pending_bytes = [left], len(left)

    def _write_docs(self) -> None:
        columns = [pa.array(v, f.type) for v, f in zip(zip(*self.docs), DOCS_SCHEMA)]
        self.writers[1].write_batch(pa.RecordBatch.from_arrays(columns, schema=DOCS_SCHEMA))
        self.docs = []

    def close(self) -> None:
        if self.pending_bytes:
            self._write_tokens(whole=False)
        if self.docs:
            self._write_docs()
        for writer, sink in zip(self.writers, self.sinks):
            writer.close()
            sink.close()


DOCS_SCHEMA = pa.schema([("doc_id", pa.int64()), ("known", pa.uint8()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def token_schema(kind: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))])


def file_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or an absolute path."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class BatchFile:
    """Random access to the batches of a stream file whose batches take the
    same number of bytes.  Local files are mapped into memory."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.source = pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)
        self.schema = pa.ipc.read_schema(pa.ipc.read_message(self.source))
        self.head = self.source.tell()
        first = self.batch_at(self.head)
        self.rows, self.step = first.num_rows, self.source.tell() - self.head

    def batch_at(self, offset: int) -> pa.RecordBatch:
        self.source.seek(offset)
        return pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)

    def batch(self, number: int) -> pa.RecordBatch:
        return self.batch_at(self.head + number * self.step)

    def close(self) -> None:
        self.source.close()


class TokenFile(BatchFile):
    """Sequences, masks and stretches of ids of one shard."""

    @property
    def length(self) -> int:
        return self.schema.field("ids").type.list_size

    def sequence(self, number: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of a sequence, as views of the file."""
        batch, row = self.batch(number // self.rows), number % self.rows
        ids, mask = (batch.column(c).flatten().slice(row * self.length, self.length) for c in range(2))
        return ids.to_numpy(zero_copy_only=True), mask

    def stretch(self, start: int, count: int) -> Iterator[np.ndarray]:
        """``count`` ids from ``start`` on, as views of the file."""
        size = self.rows * self.length
        while count > 0:
            ids = self.batch(start // size).column(0).flatten().to_numpy(zero_copy_only=True)
            part = ids[start % size : start % size + count]
            yield part
            start, count = start + len(part), count - len(part)


def write_shards(
    docs: DataFrame, folder: str, vocabulary: str | None = None, length: int = LENGTH, rows: int = ROWS, end: int = END,
    doc_rows: int = DOC_ROWS,
) -> DataFrame:
    """Writes the documents in ascending order of their id; returns the shard
    table, a row a shard, numbered in that order and kept in the shared folder.

    NULL ids come first.  Rows that share an id follow each other by the digest
    of their text.  NULL and empty texts are documents of the end id alone.
    """
    vocabulary = vocabulary or default_vocabulary()
    # The last key tells equal rows apart, so a sort can split any run of them.
    keys = ["doc_id", "digest", "copy"]
    ordered = (
        docs.select("doc_id", "text", F.unhex(F.sha2("text", 256)).alias("digest"), F.monotonically_increasing_id().alias("copy"))
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = None, None
        encoder = encoder_of(vocabulary, end)
        for batch in batches:
            for i in range(batch.num_rows):
                if shard is None:
                    shard, number = _Shard(*file_store(folder), encoder.kind, length, rows, doc_rows), batch.column(0)[i].as_py()
                shard.add(batch.column(1)[i].as_py(), encoder.pieces(batch.column(2)[i].as_py() or ""), end)
        if shard is not None:
            shard.close()
            row = [number, *shard.paths, shard.n_docs, shard.n_tokens, shard.n_sequences]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                ["shard", "tokens", "docs", "n_docs", "n_tokens", "n_sequences"],
            )

    return staged(ordered.mapInArrow(run, SHARDS), "shards")


def read_documents(
    shards: DataFrame, schema: str, work: Callable[[TokenFile, int, int], dict], doc_rows: int = DOC_ROWS
) -> DataFrame:
    """``doc_id, start, n_tokens`` of every document of the shards, and what
    ``work(file, first, count)`` gives for its stretch of ids (columns of
    ``schema``).  A task reads ``doc_rows`` documents at a time, as many as a
    batch of the document files holds."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    # One row per shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    numbered = shards.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    last = F.floor((F.col("n_docs") - 1) / doc_rows)
    parts = numbered.select("tokens", "docs", "first", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("part"))
    schema = f"doc_id bigint, start bigint, n_tokens bigint, {schema}"
    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = file_store(row["tokens"])
                ids = TokenFile(store, path)
                index = BatchFile(store, file_store(row["docs"])[1])
                found = index.batch(row["part"]).to_pydict()
                made = [work(ids, s, n) for s, n in zip(found["start"], found["n_tokens"])]
                columns = {
                    "doc_id": [i if known else None for i, known in zip(found["doc_id"], found["known"])],
                    "start": [row["first"] + s for s in found["start"]],
                    "n_tokens": found["n_tokens"],
                }
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name] if f.name in columns else [m[f.name] for m in made], f.type) for f in target], schema=target
                )
                ids.close()
                index.close()

    # The rows are small and the work behind them is not, so their number of
    # tasks must not follow their size.
    tasks = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(tasks, "docs", "part").mapInArrow(run, schema)


def checksum(ids: TokenFile, start: int, count: int) -> dict:
    """crc32 of the ids as little-endian numbers of four bytes."""
    crc = 0
    for part in ids.stretch(start, count):
        crc = zlib.crc32(part.astype("<u4", copy=False), crc)
    return {"ids_crc32": crc}


def token_sequences(
    docs: DataFrame, folder: str | None = None, vocabulary: str | None = None, length: int = LENGTH, rows: int = ROWS, end: int = END,
    doc_rows: int = DOC_ROWS,
) -> DataFrame:
    """Writes the documents' ids and gives ``doc_id, start, n_tokens,
    ids_crc32`` of each, read back from the files.

    Repeated rows are documents of their own; other columns are not read; very
    long texts are encoded and read a stretch at a time; no rows give no rows.
    """
    folder = folder or shared_dir(docs.sparkSession, "sequences")
    shards = write_shards(docs, folder, vocabulary, length, rows, end, doc_rows)
    return read_documents(shards, "ids_crc32 bigint", checksum, doc_rows)


def op12_token_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_sequences(table(spark, sf_dir, "documents"))
