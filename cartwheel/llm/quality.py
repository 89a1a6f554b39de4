"""Document quality by kernel ridge regression on text statistics.

Method.  Each text is described by a few statistics of all its bytes and words.
Random Fourier features approximate a Gaussian kernel over them; every
partition adds up its part of the normal equations, the parts are summed up,
and one small system gives ridge weights.  Raw scores are then calibrated to
chances by isotonic regression over a fixed grid of score bins.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import crc_class, map_batches, sum_arrays, table
from cartwheel.session import staged

FEATURES = 256
#: Width of the kernel in standard deviations of all statistics together.
WIDTH = 3.0
RIDGE = 1e-3
#: Cells of the raw score over which the calibration is fitted.
BINS = 2000
CUT = 0.3
STATISTICS = (
    "length", "words", "word_length", "long_words", "distinct_words", "repeated_neighbours", "top_word",
    "capitals", "capital_words", "digits", "marks", "blanks", "line_length", "ended_lines", "distinct_lines",
    "top_mark", "high_bytes", "squeezed",
)

_CLASS = np.zeros(256, np.int64)  # 0 other, 1 lower, 2 capital, 3 digit, 4 mark, 5 blank, 6 high byte
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 4
_CLASS[[9, 10, 11, 12, 13, 32]] = 5
_CLASS[128:] = 6


def statistics(text: bytes | None) -> list[float]:
    """The statistics of one whole text; zeros for NULL and empty texts."""
    if not text:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = np.bincount(_CLASS, weights=counts, minlength=7)
    size = len(text)
    words = text.split()
    n = max(1, len(words))
    tally: dict[bytes, int] = {}
    for word in words:
        tally[word] = tally.get(word, 0) + 1
    lines = [x for x in text.split(b"\n") if x.strip()]
    m = max(1, len(lines))
    letters = max(1.0, kinds[1] + kinds[2] + kinds[6])
    return [
        np.log1p(size),
        np.log1p(len(words)),
        min(size / n, 40.0),
        sum(len(w) > 12 for w in words) / n,
        len(tally) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        max(tally.values(), default=0) / n,
        kinds[2] / letters,
        sum(w.isupper() for w in words) / n,
        kinds[3] / size,
        kinds[4] / size,
        kinds[5] / size,
        np.log1p(size / m),
        sum(x.rstrip()[-1:] in b".!?" for x in lines) / m,
        len(set(lines)) / m,
        counts[_CLASS == 4].max() / size,
        kinds[6] / size,
        len(zlib.compress(text, 1)) / (size + 20),
    ]


def described(docs: DataFrame) -> DataFrame:
    """``doc_id, stats`` of each row."""
    return map_batches(
        docs.select("doc_id", "text"),
        "doc_id bigint, stats array<float>",
        lambda ids, texts: {"doc_id": ids, "stats": [statistics(t) for t in texts]},
    )


@dataclass
class QualityModel:
    """Scaling, random features, ridge weights and calibration steps."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    edges: np.ndarray  # raw scores at which a calibrated value begins
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        return _fourier((stats - self.mean) / self.scale, self.directions, self.phases)

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = self.features(stats) @ self.weights
        if not len(self.edges):
            return np.clip(raw, 0, 1)
        return np.clip(np.interp(raw, self.edges, self.levels), 0, 1)


def _fourier(scaled: np.ndarray, directions: np.ndarray, phases: np.ndarray) -> np.ndarray:
    waves = np.sqrt(2 / len(phases)) * np.cos(np.clip(scaled, -8, 8) @ directions + phases)
    return np.hstack([waves, np.ones((len(scaled), 1))])


def _partition_sums(rows: DataFrame, shape: tuple, add) -> np.ndarray | None:  # noqa: ANN001
    """Sum over all partitions of what ``add(total, stats, labels)`` adds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        seen = False
        for batch in batches:
            if batch.num_rows:
                seen = True
                stats = np.array(batch.column(0).to_pylist(), np.float64)
                add(total, stats, np.array(batch.column(1).to_pylist(), np.float64))
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    found = sum_arrays(rows.select("stats", "label").mapInArrow(run, "part binary"), "part")
    return None if found is None else found.reshape(shape)


def pool_violators(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted isotonic (rising) fit."""
    blocks: list[list[float]] = []
    for value, weight in zip(values.tolist(), weights.tolist(), strict=True):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, n = blocks.pop()
            u, x, m = blocks[-1]
            blocks[-1] = [(u * x + v * w) / (x + w), x + w, m + n]
    return np.concatenate([np.full(n, v) for v, _, n in blocks]) if blocks else np.empty(0)


def fit(rows: DataFrame, features: int = FEATURES, seed: int = 11) -> QualityModel | None:
    """Model from rows ``stats, label``; None without any.

    The driver holds one system of ``features + 1`` unknowns and ``BINS``
    calibration cells, however many rows there are.
    """
    size = len(STATISTICS)

    def moments(total: np.ndarray, stats: np.ndarray, labels: np.ndarray) -> None:
        total[0] += len(stats)
        total[1 : size + 1] += stats.sum(axis=0)
        total[size + 1 :] += (stats**2).sum(axis=0)

    sums = _partition_sums(rows, (2 * size + 1,), moments)
    if sums is None:
        return None
    mean = sums[1 : size + 1] / sums[0]
    scale = np.sqrt(np.maximum(sums[size + 1 :] / sums[0] - mean**2, 0))
    scale[scale < 1e-6] = 1.0
    draw = np.random.default_rng(seed)
    model = QualityModel(
        mean, scale, draw.normal(0, 1 / WIDTH, (size, features)), draw.uniform(0, 2 * np.pi, features),
        np.zeros(features + 1), np.empty(0), np.empty(0),
    )

    def normal(total: np.ndarray, stats: np.ndarray, labels: np.ndarray) -> None:
        waves = model.features(stats)
        total[:, :-1] += waves.T @ waves
        total[:, -1] += waves.T @ labels

    system = _partition_sums(rows, (features + 1, features + 2), normal)
    damp = RIDGE * sums[0] * np.eye(features + 1) / features
    damp[-1, -1] = 0
    model.weights = np.linalg.solve(system[:, :-1] + damp, system[:, -1])

    def cells(total: np.ndarray, stats: np.ndarray, labels: np.ndarray) -> None:
        cell = np.clip(((model.features(stats) @ model.weights) + 0.5) / 2 * BINS, 0, BINS - 1).astype(int)
        total[0] += np.bincount(cell, minlength=BINS)
        total[1] += np.bincount(cell, weights=labels, minlength=BINS)

    held, good = _partition_sums(rows, (2, BINS), cells)
    used = np.flatnonzero(held)
    model.edges = (used + 0.5) * 2 / BINS - 0.5
    model.levels = pool_violators(good[used] / held[used], held[used])
    return model


def scored(stats: DataFrame, model: QualityModel | None) -> DataFrame:
    """``doc_id, score, predicted``; half and half without a model."""

    def work(ids: list, values: list) -> dict:
        score = np.full(len(ids), 0.5) if model is None else model.score(np.array(values, np.float64).reshape(len(ids), -1))
        return {"doc_id": ids, "score": score, "predicted": (score >= CUT).astype(np.int32)}

    return map_batches(stats.select("doc_id", "stats"), "doc_id bigint, score double, predicted int", work, rows=4096)


def held_out() -> Column:
    return F.coalesce(crc_class(F.col("doc_id"), 5) == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs``.

    Learns from the labelled rows that are not held out.  Texts that are NULL
    or empty are scored as texts without a word.  A document with several
    labels teaches their mean; NULL labels and rows without a doc_id teach
    nothing; repeated rows are scored each.  Other columns are not read.
    """
    stats = staged(described(docs), "statistics")
    truth = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("label"))
    taught = staged(stats.where(~held_out()).join(truth, "doc_id").select("stats", "label"), "taught")
    return scored(stats, fit(taught)).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
