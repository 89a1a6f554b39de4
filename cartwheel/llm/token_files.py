"""Token counts from flat token files without an index.

Method.  A token file is nothing but numbers of two bytes, each document ended
by a separator token.  Files are read in blocks cut without regard to documents;
numpy searches a block for separators at once.  A block yields the lengths that
lie inside it and its open head and tail.  A prefix scan over each file's blocks
then adds up documents that span blocks and numbers them.

Writers make such files from texts: each task streams its documents to one file
in the shared folder and gives out the order of its documents.  Only files named in
that order table count, so a task that is repeated does no harm.
"""

from __future__ import annotations

import base64
import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import table
from cartwheel.session import shared_dir, staged

#: Vocabulary file, the same place on all executors.  A parameter everywhere.
RANKS = os.environ.get("CARTWHEEL_TOKEN_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The number that ends a document; no text encodes to it.
SEPARATOR = 50256
BLOCK_BYTES = 4 << 20


@lru_cache(maxsize=2)
def tokenizer(ranks: str) -> tiktoken.Encoding:
    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or an absolute path."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_token_files(docs: DataFrame, folder: str, ranks: str = RANKS, separator: int = SEPARATOR) -> DataFrame:
    """Writes one token file a task under ``folder``; returns the order table
    ``file, n_bytes, number, doc_id`` (written to the shared folder).

    NULL and empty texts are documents without tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        encode = tokenizer(ranks).encode_ordinary
        name, ids, written = f"{path}/{uuid.uuid4().hex}.tokens", [], 0
        end = np.array([separator], np.uint16).tobytes()
        out = None
        for batch in batches:
            if out is None and batch.num_rows:
                store.create_dir(path, recursive=True)
                out = store.open_output_stream(name)
            ids.append(batch.column(0))
            for text in batch.column(1):
                tokens = np.array(encode(text.as_py() or ""), np.uint16).tobytes()
                out.write(tokens)
                out.write(end)
                written += len(tokens) + len(end)
        if out is None:
            return
        out.close()
        number = 0
        for part in ids:
            n = len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n), pa.array([written] * n, pa.int64()), pa.array(range(number, number + n), pa.int64()), part],
                ["file", "n_bytes", "number", "doc_id"],
            )
            number += n

    return staged(
        docs.select("doc_id", "text").mapInArrow(run, "file string, n_bytes bigint, number bigint, doc_id bigint"), "token-order"
    )


def split_lengths(tokens: np.ndarray, separator: int) -> tuple[int, int | None, list[int], int]:
    """Separators of a block, tokens before the first (None without any),
    lengths between them, tokens after the last."""
    ends = np.flatnonzero(tokens == separator)
    if not len(ends):
        return 0, None, [], len(tokens)
    return len(ends), int(ends[0]), (np.diff(ends) - 1).tolist(), int(len(tokens) - 1 - ends[-1])


def scan_blocks(files: DataFrame, folder: str, separator: int = SEPARATOR, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """What each block of each of ``files`` (``file, n_bytes``) holds."""
    blocks = files.select(
        "file", "n_bytes", F.explode(F.sequence(F.lit(0), F.floor((F.greatest(F.col("n_bytes"), F.lit(1)) - 1) / block_bytes))).alias("block")
    ).repartition("file", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                start = row["block"] * block_bytes
                with store.open_input_file(row["file"]) as source:
                    data = source.read_at(min(block_bytes, row["n_bytes"] - start), start)
                found, head, inner, tail = split_lengths(np.frombuffer(data, np.uint16), separator)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]]), pa.array([row["block"]], pa.int64()), pa.array([found], pa.int64()),
                        pa.array([head], pa.int64()), pa.array([inner], pa.list_(pa.int64())), pa.array([tail], pa.int64()),
                    ],
                    ["file", "block", "found", "head", "inner", "tail"],
                )

    return blocks.mapInArrow(run, "file string, block bigint, found bigint, head bigint, inner array<bigint>, tail bigint")


def stitched(blocks: DataFrame) -> DataFrame:
    """``file, number, n_tokens``: documents of a file in order.

    The scan works on one small row a block: documents begun before a block,
    and open tokens since the last block with a separator.  Tokens behind the
    last separator of a file are no document.
    """
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    numbered = blocks.withColumn("number", F.coalesce(F.sum("found").over(before), F.lit(0))).withColumn(
        "run", F.coalesce(F.sum((F.col("found") > 0).cast("int")).over(before), F.lit(0))
    )
    # Blocks before this one that belong to the same run of open tokens: the
    # last one with a separator gives its tail, those behind it all they hold.
    same = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last_tail = F.coalesce(
        F.last(F.when(F.col("found") > 0, F.col("tail")), ignorenulls=True).over(before), F.lit(0)
    )
    open_tokens = F.coalesce(F.sum(F.when(F.col("found") == 0, F.col("tail"))).over(same), F.lit(0)) + last_tail
    lengths = F.concat(F.array(F.col("head") + F.col("open")), F.col("inner"))
    return (
        numbered.withColumn("open", open_tokens)
        .where("found > 0")
        .select("file", "number", F.posexplode(lengths).alias("at", "n_tokens"))
        .select("file", (F.col("number") + F.col("at")).alias("number"), "n_tokens")
    )


def count_tokens(docs: DataFrame, folder: str | None = None, ranks: str = RANKS, separator: int = SEPARATOR, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_tokens`` of each row, counted from token files.

    NULL and empty texts count 0; repeated rows and NULL ids are counted
    each; other columns are not read.  No rows in, no rows out.
    """
    spark = docs.sparkSession
    folder = folder or shared_dir(spark, "tokens")
    order = write_token_files(docs, folder, ranks, separator)
    files = order.select("file", "n_bytes").distinct()
    counts = stitched(scan_blocks(files, folder, separator, block_bytes))
    # Spark takes the counts for as small as the blocks they are unpacked from
    # and would send a row for each document through the driver.
    return order.join(counts.hint("merge"), ["file", "number"]).select("doc_id", "n_tokens")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
