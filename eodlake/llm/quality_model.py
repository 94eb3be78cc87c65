"""Quality classifier: naive Bayes support vectors over n-gram indicators.

Features are indicators of a text's byte n-grams (1 to 3 of the lower-cased text and its letter cases) and of how
often its word 3-grams repeat, hashed to 2^18 numbers. Class counts of every feature are taken over at most LABELLED_ROWS labelled
rows; indicators are scaled by the log-count ratio of the classes, and a linear hinge-loss model is fitted by
dual coordinate descent on a seeded sample of at most SAMPLE_ROWS labelled rows. A sigmoid turns margins into scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 18
#: Bound of the sample that the linear model is fitted on, rows of each label alike.
SAMPLE_ROWS = 3000
#: Bound of the labelled rows, of label 0 and 1, that class counts are taken from.
LABELLED_ROWS = (10_000, 10_000)
ALPHA = 1.0
COST = 0.1
EPOCHS = 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def features(text: bytes) -> np.ndarray:
    """The numbers of a text's indicators, ascending. An empty text has the one of its length only."""
    raw = np.frombuffer(text, np.uint8).astype(np.uint64)
    lower = np.frombuffer(text.lower(), np.uint8).astype(np.uint64)
    codes = [np.array([len(text).bit_length()], np.uint64)]
    for n, source in ((1, raw), (2, lower), (3, lower)):
        if len(source) >= n:
            value = source[: len(source) - n + 1]
            for k in range(1, n):
                value = value << np.uint64(8) | source[k : len(source) - n + 1 + k]
            codes.append(value | np.uint64(n << 28))
    words = text.lower().split()
    if len(words) >= 3:
        grams = set(zip(words, words[1:], words[2:]))
        repeated = 10 * (len(words) - 2 - len(grams)) // (len(words) - 2)
        codes.append(np.arange(1 + repeated, dtype=np.uint64) | np.uint64(5 << 28))
    hashed = (np.concatenate(codes) + np.uint64(1)) * _MIX >> np.uint64(64 - BITS)
    seen = np.zeros(1 << BITS, bool)
    seen[hashed.astype(np.int64)] = True
    return np.flatnonzero(seen)


@dataclass
class Model:
    """Weights of all features, log-count ratios included, and the sigmoid of the margin."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        margins = np.array([_margin(self.weights, features(t)) for t in texts], np.float64) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def _margin(weights: np.ndarray, found: np.ndarray) -> float:
    return float(weights[found].sum() / np.sqrt(len(found)))


def log_count_ratios(labelled: DataFrame) -> np.ndarray:
    """Of every feature, over all rows of `labelled` (text binary, label int); 0 if no row has it."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                counts[label, features(text.as_py() or b"")] += 1
        at = np.flatnonzero(counts.sum(0))
        yield pa.RecordBatch.from_pydict({"feature": at.astype(np.int32), "n0": counts[0, at], "n1": counts[1, at]})

    found = (
        labelled.select("text", "label")
        .mapInArrow(counted, "feature int, n0 long, n1 long")
        .groupBy("feature")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .toArrow()  # 2^18 rows at most
    )
    counts = np.full((2, 1 << BITS), ALPHA)
    at = found["feature"].to_numpy()
    counts[0, at] += found["n0"].to_numpy()
    counts[1, at] += found["n1"].to_numpy()
    shares = counts / counts.sum(1, keepdims=True)
    return np.log(shares[1] / shares[0])


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 5) -> Model:
    """A model of `labelled` (text, label 0 or 1). Rows with a null label are left out; without rows of both labels,
    every score is the share of label 1 (0.5 without rows)."""
    labelled = labelled.where("label in (0, 1)").select(F.col("text").cast("binary").alias("text"), F.col("label").cast("int").alias("label"))
    totals = {r.label: r.n for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        share = 0.5 if not totals else min(max(float(next(iter(totals))), 0.01), 0.99)
        return Model(np.zeros(1 << BITS), 0.0, 1.0, float(np.log(share / (1 - share))))
    ratios = log_count_ratios(labelled)
    sample = labelled.sampleBy("label", {k: min(1.0, sample_rows / 2 / n) for k, n in totals.items()}, seed)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py() or b"").astype(np.int32) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["label", "features"])

    rows = sample.mapInArrow(listed, "label int, features array<int>").toArrow()
    sets = [r.values.to_numpy().astype(np.int64) for r in rows["features"]]
    y = 2 * rows["label"].to_numpy().astype(np.int64) - 1
    half = np.arange(len(rows)) % 4 > 0
    w, bias = dual_descent([s for s, h in zip(sets, half) if h], y[half], ratios, seed)
    margins = np.array([_margin(w, s) for s in sets]) + bias
    slope, shift = sigmoid(margins[~half], y[~half])
    return Model(w, bias, slope, shift)


def dual_descent(sets: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, seed: int, cost: float = COST, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise |w|^2 / 2 + cost * hinge losses, one dual variable after the other."""
    w, bias, dual = np.zeros(1 << BITS), 0.0, np.zeros(len(y))
    values = [ratios[s] / np.sqrt(len(s)) for s in sets]
    norms = np.array([v @ v + 1 for v in values])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        most = 0.0
        for i in order.permutation(len(y)):
            gradient = y[i] * (w[sets[i]] @ values[i] + bias) - 1
            new = min(max(dual[i] - gradient / norms[i], 0.0), cost)
            step = (new - dual[i]) * y[i]
            if step:
                w[sets[i]] += step * values[i]
                bias += step
                most = max(most, abs(step))
                dual[i] = new
        if most < 1e-4 * cost:
            break
    return w * ratios, bias


def sigmoid(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic fit of labels to margins, both labels of equal weight and smoothed (Newton steps)."""
    n1, n0 = np.sum(y > 0), np.sum(y < 0)
    goal = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y > 0, 0.5 / max(n1, 1), 0.5 / max(n0, 1)) * len(y)
    x = np.stack([margins, np.ones(len(margins))], 1)
    beta, ridge = np.array([1.0, 0.0]), 1e-3 * np.eye(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (goal - p)) - ridge @ beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(beta[0], 1e-6)), float(beta[1])


def score(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` and the score of every row, 0 to 1; null and empty texts are scored as empty ones."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    chosen = df.select(*keep, F.col(text).cast("binary").alias("scored_text"))
    schema = df.select(*keep).schema.add("score", "double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sent.value.scores([t.as_py() or b"" for t in batch.column(batch.num_columns - 1)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], names=schema.names)

    return chosen.mapInArrow(scored, schema)
