"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

Every whole text is measured by ``STATISTICS``. Random Fourier features of the standardised
statistics approximate a Gaussian kernel; each task adds up its share of the normal equations of
a ridge regression on the labels, the shares are summed on executors, and the small system is
solved once. A fifth of the labelled rows is kept from the fit: on it an isotonic curve turns raw
scores into probabilities. The curve is fitted on counts by raw score, in ``BINS`` equal steps.

Defined results: a null text counts as empty, and empty texts are scored like any other; rows
without a label or an id are not learned from, but scored; several labels of one id are averaged;
without anything to learn from every score is 0.5; an empty table gives an empty result; repeated
rows get equal scores. Other columns are not looked at. Memory is bounded by pieces of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.llm.arrowtext import SUMS, buffers, partial_sums, pieces, summed, words
from tristrata.scratch import staged

FEATURES = 256
#: Width of the kernel, in standard deviations per root of the number of statistics.
WIDTH = 1.5
RIDGE = 1e-4
#: Steps of the raw score that the isotonic curve distinguishes, and their range.
BINS = 1024
LOW, HIGH = -0.5, 1.5
#: Share of the raw score that is mixed in, so that rows of one isotonic block keep an order.
BLEND = 0.01
#: Of so many parts of the labelled rows one is kept for calibration.
FOLDS = 5
SEED = 5

#: Kinds of bytes that are counted.
UPPER, LOWER, DIGIT, SPACE, LINE, POINT, SYMBOL, BEYOND = range(8)
KIND = np.full(256, SYMBOL, np.uint8)
KIND[0x41:0x5B], KIND[0x61:0x7B], KIND[0x30:0x3A], KIND[0x80:] = UPPER, LOWER, DIGIT, BEYOND
KIND[[0x20, 0x09, 0x0B, 0x0C, 0x0D]], KIND[0x0A] = SPACE, LINE
KIND[[ord(c) for c in ".,;:'\"()-?"]] = POINT
KEEP = np.arange(256, dtype=np.uint8)

STATISTICS = [
    "log bytes", "log words", "upper case", "digits", "symbols", "points", "beyond ASCII",
    "line ends", "mean word", "spread of words", "distinct words", "top word", "repeated neighbours",
    "distinct pairs", "words of one byte", "words without letters", "words with symbols",
    "long words", "log mean line", "repeated lines", "lines that end in a point", "capital words",
    "bytes of repeated words", "shouting words",
]


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the runs between offsets."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[at[1:]] - total[at[:-1]]


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of statistics for each text."""
    n = len(texts)
    at, raw = buffers(texts)
    size = np.diff(at)
    kinds = KIND[raw]
    of = [sums(kinds == k, at) for k in range(8)]
    filled = np.maximum(size - of[SPACE] - of[LINE], 1)
    ids, word_at, vocabulary = words(texts, KEEP)
    v_at, v_raw = buffers(vocabulary) if len(vocabulary) else (np.zeros(1, np.int64), raw[:0])
    v_kind = KIND[v_raw]
    v_size = np.diff(v_at)
    v_upper, v_lower = sums(v_kind == UPPER, v_at), sums(v_kind == LOWER, v_at)
    v_letters = v_upper + v_lower + sums(v_kind == BEYOND, v_at)
    v_symbols = sums(v_kind == SYMBOL, v_at)
    first_upper = np.zeros(len(v_size), bool)
    if len(v_size):
        first_upper = v_kind[v_at[:-1]] == UPPER
    count = np.diff(word_at)
    some = np.maximum(count, 1)
    length = v_size[ids]
    mean = sums(length, word_at) / some
    spread = np.sqrt(np.maximum(sums(length.astype(float) ** 2, word_at) / some - mean**2, 0))
    same = np.zeros(len(ids), np.int64)
    same[1:] = ids[1:] == ids[:-1]
    inner = word_at[:-1][count > 0]
    same[inner] = 0
    out = np.zeros((n, len(STATISTICS)))
    pair = ids.copy()
    pair[:-1] = ids[:-1] * max(len(v_size), 1) + ids[1:]
    for i, text in enumerate(texts.to_pylist()):
        own = ids[word_at[i] : word_at[i + 1]]
        if len(own):
            distinct, times = np.unique(own, return_counts=True)
            out[i, 10] = len(distinct) / len(own)
            out[i, 11] = times.max() / len(own)
            out[i, 13] = len(np.unique(pair[word_at[i] : word_at[i + 1] - 1])) / max(len(own) - 1, 1)
            out[i, 22] = 1 - v_size[distinct].sum() / max(v_size[own].sum(), 1)
        lines = [x for x in text.split("\n") if x]
        if lines:
            out[i, 18] = np.log1p(len(text) / len(lines))
            out[i, 19] = 1 - len(set(lines)) / len(lines)
            out[i, 20] = sum(x[-1] in ".!?:;" for x in lines) / len(lines)
    columns = {
        0: np.log1p(size),
        1: np.log1p(count),
        2: of[UPPER] / filled,
        3: of[DIGIT] / filled,
        4: of[SYMBOL] / filled,
        5: of[POINT] / filled,
        6: of[BEYOND] / filled,
        7: of[LINE] / np.maximum(size, 1),
        8: mean,
        9: spread,
        12: sums(same, word_at) / some,
        14: sums(length == 1, word_at) / some,
        15: sums((v_letters == 0)[ids], word_at) / some,
        16: sums((v_symbols > 0)[ids], word_at) / some,
        17: sums(length > 20, word_at) / some,
        21: sums(first_upper[ids], word_at) / some,
        23: sums(((v_upper > 1) & (v_lower == 0))[ids], word_at) / some,
    }
    for k, column in columns.items():
        out[:, k] = column
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    #: Raw scores and calibrated scores of the curve's knots.
    knots: tuple[np.ndarray, np.ndarray]
    weights: np.ndarray


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of statistics, and a constant."""
    rng = np.random.default_rng(SEED)
    d = x.shape[1]
    w = rng.normal(size=(d, FEATURES)) / (WIDTH * np.sqrt(d))
    b = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.sqrt(2 / FEATURES) * np.cos(np.clip((x - mean) / scale, -8, 8) @ w + b)
    return np.hstack([z, np.ones((len(x), 1))])


def raw_scores(x: np.ndarray, model: Model) -> np.ndarray:
    return fourier(x, model.mean, model.scale) @ model.weights


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing curve nearest to ``y``: pool adjacent violators."""
    blocks: list[list[float]] = []
    for a, b, c in zip(x.tolist(), y.tolist(), w.tolist()):
        blocks.append([a * c, b * c, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return (
        np.array([b[0] / b[2] for b in blocks]),
        np.array([b[1] / b[2] for b in blocks]),
    )


def calibrated(raw: np.ndarray, model: Model) -> np.ndarray:
    x, y = model.knots
    if not len(x):
        return np.full(len(raw), 0.5)
    rank = np.clip((raw - LOW) / (HIGH - LOW), 0, 1)
    return (1 - BLEND) * np.interp(raw, x, y) + BLEND * rank


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = np.frombuffer(b"".join(batch.column("stats").to_pylist()), "<f8")
    return flat.reshape(batch.num_rows, len(STATISTICS))


def measured(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` with ``stats``, the statistics of each text as packed doubles."""
    names = keep or [c for c in docs.columns if c != "stats"]
    schema = docs.select(names).schema.add("stats", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, text_col):
            rows = pa.array([r.tobytes() for r in statistics(texts).astype("<f8")], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], rows], names=[*names, "stats"]
            )

    return docs.mapInArrow(run, schema)


def fit(rows: DataFrame) -> Model:
    """A model of rows ``stats, y, fold``; fold 0 is kept for the calibration."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, len(STATISTICS)))
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch)
                total += [np.full(x.shape[1], len(x)), x.sum(0), (x**2).sum(0)]
        yield partial_sums({"moments": total.ravel()})

    found = summed(rows.mapInArrow(moments, SUMS))
    none = np.zeros(len(STATISTICS))
    n, one, two = found["moments"].reshape(3, -1) if found else (none, none, none)
    n = np.maximum(n, 1)
    mean = one / n
    scale = np.sqrt(np.maximum(two / n - mean**2, 0))
    scale = np.where(scale > 1e-9, scale, 1)
    size = FEATURES + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                z = fourier(matrix(batch), mean, scale)
                y = batch.column("y").to_numpy(zero_copy_only=False)
                total += z.T @ np.hstack([z, y[:, None]])
        yield partial_sums({"equations": total.ravel()})

    found = summed(rows.where("fold != 0").mapInArrow(equations, SUMS))
    total = found["equations"].reshape(size, size + 1) if found else np.zeros((size, size + 1))
    many = max(total[-1, -2], 1)
    weights = np.linalg.solve(total[:, :-1] + RIDGE * many * np.eye(size), total[:, -1])
    model = Model(mean, scale, (np.zeros(0), np.zeros(0)), weights)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BINS))
        for batch in batches:
            if batch.num_rows:
                raw = (raw_scores(matrix(batch), model) - LOW) / (HIGH - LOW)
                slot = np.clip((raw * BINS).astype(np.int64), 0, BINS - 1)
                y = batch.column("y").to_numpy(zero_copy_only=False)
                total += [np.bincount(slot, minlength=BINS), np.bincount(slot, y, BINS)]
        yield partial_sums({"bins": total.ravel()})

    found = summed(rows.where("fold = 0").mapInArrow(binned, SUMS))
    count, good = found["bins"].reshape(2, BINS) if found else np.zeros((2, BINS))
    used = np.flatnonzero(count)
    if not len(used):
        used, count, good = np.array([BINS // 2]), np.ones(BINS), np.full(BINS, 0.5)
    centre = LOW + (used + 0.5) * (HIGH - LOW) / BINS
    model.knots = isotonic(centre, good[used] / count[used], count[used])
    return model


def scored(rows: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with ``score`` and ``predicted`` of rows that have ``stats``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = rows.select(keep).schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.zeros(0)
            if batch.num_rows:
                score = calibrated(raw_scores(matrix(batch), shared.value), shared.value)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in keep],
                    pa.array(score, pa.float64()),
                    pa.array((score >= 0.5).astype(np.int32), pa.int32()),
                ],
                names=[*keep, "score", "predicted"],
            )

    return rows.mapInArrow(run, schema)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row, learned from labelled rows that are
    not held out."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held_out.alias("held_out")
    )
    rows = staged(measured(rows, keep=["doc_id", "held_out"]), "statistics")
    known = (
        labels.where(F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("doc_id"))
        .agg(F.avg(F.col(label_col)).alias("y"))
    )
    train = rows.where("NOT held_out").join(known, "doc_id").select(
        "stats", "y", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(FOLDS)).alias("fold")
    )
    model = fit(staged(train, "train"))
    return scored(rows, model, ["doc_id", "held_out"])
