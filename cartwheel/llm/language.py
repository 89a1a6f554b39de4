"""Language identification with a byte-level convolutional network.

Bytes are embedded, filters of several widths run over fixed-length windows,
each filter keeps its maximum over the window, and a softmax layer names the
language.  The network is trained in numpy on a bounded sample of labelled
documents; every document is then cut into windows over its whole length, and
the window scores are averaged by the bytes they cover.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import crc_class, map_batches, table
from cartwheel.session import staged

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 8
EMBEDDING = 8
#: Bound of the training sample: documents of each language, windows of each.
PER_LANGUAGE = 400
WINDOWS_EACH = 4
EPOCHS = 4
LEARNING_RATE = 0.004
UNDETERMINED = "und"
#: Windows that go through the network at once.
BLOCK = 32


@dataclass
class ByteNet:
    """Weights; ``kernel`` holds all widths, shorter filters padded by zeros."""

    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING, byte 0 pads
    kernel: np.ndarray  # (max width * EMBEDDING) x all filters
    bias: np.ndarray
    out: np.ndarray  # all filters x languages
    out_bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        patches = self._patches(self.embedding[windows])
        scores = (patches.reshape(-1, patches.shape[-1]) @ self.kernel).reshape(*patches.shape[:2], -1)
        return np.maximum(scores.max(axis=1) + self.bias, 0)

    def _patches(self, embedded: np.ndarray) -> np.ndarray:
        reach = max(WIDTHS)
        n, length, size = embedded.shape
        padded = np.zeros((n, length + reach - 1, size), embedded.dtype)
        padded[:, :length] = embedded
        a, b, c = padded.strides
        return np.lib.stride_tricks.as_strided(padded, (n, length, reach * size), (a, b, c)).copy()

    def logits(self, windows: np.ndarray) -> np.ndarray:
        return np.concatenate(
            [self.pooled(windows[i : i + BLOCK]) @ self.out + self.out_bias for i in range(0, len(windows), BLOCK)]
            or [np.empty((0, len(self.languages)), np.float32)]
        )


def _mask() -> np.ndarray:
    mask = np.zeros((max(WIDTHS) * EMBEDDING, len(WIDTHS) * FILTERS), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[: width * EMBEDDING, i * FILTERS : (i + 1) * FILTERS] = 1
    return mask


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 7) -> ByteNet:
    """Fits the network by Adam on softmax cross-entropy."""
    draw, mask = np.random.default_rng(seed), _mask()
    net = ByteNet(
        languages,
        draw.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        (draw.normal(0, 0.2, mask.shape) * mask).astype(np.float32),
        np.zeros(mask.shape[1], np.float32),
        draw.normal(0, 0.2, (mask.shape[1], len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    net.embedding[0] = 0
    names = ("embedding", "kernel", "bias", "out", "out_bias")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    step = 0
    for _ in range(epochs):
        order = draw.permutation(len(windows))
        for start in range(0, len(order), 64):
            pick = order[start : start + 64]
            batch, truth = windows[pick], labels[pick]
            patches = net._patches(net.embedding[batch])
            n, length, size = patches.shape
            scores = (patches.reshape(-1, size) @ net.kernel).reshape(n, length, -1)
            best = scores.argmax(axis=1)
            top = np.take_along_axis(scores, best[:, None], 1)[:, 0] + net.bias
            hidden = np.maximum(top, 0)
            logits = hidden @ net.out + net.out_bias
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            chance[np.arange(n), truth] -= 1
            chance /= n
            back = (chance @ net.out.T) * (top > 0)
            chosen = patches[np.arange(n)[:, None], best]  # n x filters x patch
            grad = {
                "out": hidden.T @ chance,
                "out_bias": chance.sum(axis=0),
                "bias": back.sum(axis=0),
                "kernel": np.einsum("nf,nfp->pf", back, chosen) * mask,
            }
            spread = back[:, :, None] * net.kernel.T[None]  # n x filters x patch
            place = best[:, :, None] + np.arange(max(WIDTHS))
            symbols = np.where(place < length, batch[np.arange(n)[:, None, None], np.minimum(place, length - 1)], 0)
            grad["embedding"] = np.zeros_like(net.embedding)
            np.add.at(grad["embedding"], symbols, spread.reshape(*symbols.shape, EMBEDDING))
            grad["embedding"][0] = 0
            step += 1
            for k in names:
                first[k] = 0.9 * first[k] + 0.1 * grad[k]
                second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
                rate = LEARNING_RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                setattr(net, k, (getattr(net, k) - rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32))
    return net


def cut_windows(text: bytes) -> np.ndarray:
    """The whole text as rows of ``WINDOW`` bytes, the last filled with 0."""
    count = -(-len(text) // WINDOW)
    grid = np.zeros(count * WINDOW, np.uint8)
    grid[: len(text)] = np.frombuffer(text, np.uint8)
    return grid.reshape(count, WINDOW)


def sample_windows(docs: DataFrame, per_language: int = PER_LANGUAGE, each: int = WINDOWS_EACH) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Training windows of at most ``per_language`` documents of each language.

    Those with the least hashes of id and text are drawn, windows at hashed
    places of the whole text and in several lengths.  Rows that repeat id and
    text are drawn once.  At most ``per_language`` rows a language are
    sent to the tasks and reach the driver.
    """
    usable = docs.where("lang IS NOT NULL AND text IS NOT NULL AND text <> ''").select(
        "lang", F.xxhash64("doc_id", "text").alias("ticket"), "text"
    )
    marks = staged(usable.select("lang", "ticket").distinct(), "tickets")
    # Hashes below a bound that twice as many rows are expected to reach, so
    # that the ranking of a language stays small however many rows it has.
    bound: Column = F.lit(None).cast("bigint")
    for row in marks.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect():
        highest = min(2**63 - 1, -(2**63) + 2 * per_language * 2**64 // row.n)
        bound = F.when(F.col("lang") == row.lang, F.lit(highest)).otherwise(bound)
    drawn = (
        marks.where(F.col("ticket") <= bound)
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("ticket")))
        .where(F.col("place") <= per_language)
        .select("lang", "ticket")
    )

    def pick(tickets: list, langs: list, texts: list) -> dict:
        cut = []
        for mark, text in zip(tickets, texts, strict=True):
            draw = np.random.default_rng(mark & (2**64 - 1))
            parts = []
            for length in (WINDOW, WINDOW, WINDOW // 2, WINDOW // 5)[:each]:
                start = int(draw.integers(0, max(1, len(text) - length + 1)))
                parts.append(text[start : start + length].ljust(WINDOW, b"\0"))
            cut.append(b"".join(parts))
        return {"ticket": tickets, "lang": [x.decode() for x in langs], "cut": cut}

    cuts = map_batches(
        usable.join(F.broadcast(drawn), ["lang", "ticket"], "left_semi").select("ticket", "lang", "text"), "ticket bigint, lang string, cut binary", pick
    )
    rows = cuts.groupBy("lang", "ticket").agg(F.first("cut").alias("cut")).collect()
    languages = sorted({r.lang for r in rows})
    windows, labels = [], []
    for number, lang in enumerate(languages):
        for _, cut in sorted((r.ticket, bytes(r.cut)) for r in rows if r.lang == lang):
            grid = np.frombuffer(cut, np.uint8).reshape(-1, WINDOW)
            windows.append(grid)
            labels += [number] * len(grid)
    return np.concatenate(windows or [np.empty((0, WINDOW), np.uint8)]), np.array(labels, np.int64), languages


def fit(docs: DataFrame) -> ByteNet | None:
    """Network for the languages of ``docs``; None without labelled text."""
    windows, labels, languages = sample_windows(docs)
    return train(windows, labels, languages) if len(windows) else None


def predict(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """``doc_id, lang_pred, score`` of each row.

    ``und`` with a score of 0 where the text is NULL or has no letter, or
    nothing was learned.  Equal texts get equal answers; repeated rows are
    answered each; other columns are not read.
    """
    named = docs.select(
        "doc_id",
        F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"),
    )

    def work(ids: list, texts: list) -> dict:
        langs, scores = [UNDETERMINED] * len(ids), [0.0] * len(ids)
        if net is not None:
            for i, text in enumerate(texts):
                if text:
                    chance = _judged(net, text)
                    langs[i], scores[i] = net.languages[int(chance.argmax())], float(chance.max())
        return {"doc_id": ids, "lang_pred": langs, "score": scores}

    return map_batches(named, "doc_id bigint, lang_pred string, score double", work)


def _judged(net: ByteNet, text: bytes) -> np.ndarray:
    """Chance of each language, window scores weighted by their bytes."""
    grid = cut_windows(text)
    weights = np.full(len(grid), WINDOW, np.float64)
    weights[-1] = len(text) - WINDOW * (len(grid) - 1)
    mean = weights @ net.logits(grid) / weights.sum()
    chance = np.exp(mean - mean.max())
    return chance / chance.sum()


def keep_known(docs: DataFrame, net: ByteNet | None, floor: float) -> DataFrame:
    """The rows of ``docs`` whose text is in a known language.

    Rows with a NULL text, without a letter, or with a best chance below
    ``floor`` go; all columns pass through untouched.  Without a network every
    text with a letter stays.
    """
    lettered = docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    if net is None:
        return lettered
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sure = [_judged(net, t.encode()).max() >= floor for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(sure, pa.bool_()))

    return lettered.mapInArrow(run, docs.schema)


def held_out() -> Column:
    return F.coalesce(crc_class(F.col("doc_id"), 4) == 2, F.lit(False))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction for each document; documents whose crc32 of the id, modulo
    4, is 2 are never learned from."""
    docs = table(spark, sf_dir, "documents")
    net = fit(docs.where(~held_out()))
    return predict(docs, net).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
