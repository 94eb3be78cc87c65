"""Toxicity by compression distance.

Each window of twelve words is compressed with a toxic and with an ordinary dictionary; where the toxic one makes it shorter,
the window speaks as toxic texts do. The lengths saved over a text's windows are set against thresholds and become a score;
thresholds and weights come from texts that made no dictionary.

Both dictionaries end in the same trained dictionary of ordinary windows, so that ordinary words cost the same in both. Before
it lies, in one, every word told far more often in toxic than in ordinary texts, in the other as much more ordinary text.
This list takes the place of a dictionary trained on toxic windows, which finds less in held-out rows (README has figures);
where too few toxic texts are known to tell words apart, such a dictionary is trained after all.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bounds of the labelled sample, in rows.
TOXIC_ROWS = 2000
ORDINARY_ROWS = 4000
WINDOW = 12
LEVEL = 6
DICTIONARY_BYTES = 256 << 10
#: A word is told apart when toxic texts have it so many times as often.
RATIO = 5
#: The thresholds are these quantiles of what windows of the calibration texts save, where they save anything.
QUANTILES = (0.2, 0.4, 0.6, 0.8)
_BLANKS = bytes.maketrans(b'.,;:!?"()|*#$%&<>\n\t\r\x0b\x0c', b" " * 22)


def words(text: bytes) -> list[bytes]:
    return text.lower().translate(_BLANKS).split()


def windows(text: bytes) -> list[bytes]:
    w = words(text)
    return [b" " + b" ".join(w[i : i + WINDOW]) + b" " for i in range(0, len(w), WINDOW)]


def _trained(samples: list[bytes]) -> bytes:
    """A trained dictionary; the samples themselves if they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=32, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def dictionaries(toxic: list[bytes], ordinary: list[bytes], seed: int) -> tuple[bytes, bytes]:
    """The toxic and the ordinary dictionary."""
    often = Counter(w for t in toxic for w in set(words(t)))
    seldom = Counter(w for t in ordinary for w in set(words(t)))
    telling = [w for w, n in often.items() if n >= 3 and n * len(ordinary) > RATIO * (seldom[w] + 1) * len(toxic)]
    telling.sort(key=lambda w: (often[w], w))  # the most frequent last, where matches cost least
    own = b"".join(b" " + w + b" " for w in telling)
    samples, rng = [x for t in ordinary for x in windows(t)], np.random.default_rng(seed)
    rng.shuffle(samples)
    base = _trained(samples[:200_000])
    other = b"".join(samples[: len(own) // 20 + 1])
    if not own:
        found = [x for t in toxic for x in windows(t)]
        rng.shuffle(found)
        own, other = _trained(found[:200_000]), _trained(samples[: len(found)])
    size = min(len(own), len(other))  # a trained dictionary has its best parts at the end
    return (own if telling else own[len(own) - size :]) + base, (other[:size] if telling else other[len(other) - size :]) + base


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    weights: np.ndarray | None = None
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    share: float = 0.0
    thresholds: np.ndarray | None = None

    def start(self) -> None:
        """Make the compressors; once in each task."""
        self.packers = []
        for content in (self.toxic, self.ordinary):
            data = zstandard.ZstdCompressionDict(content or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            self.packers.append(
                zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)
            )

    def saved(self, text: bytes) -> np.ndarray:
        """Bytes that the toxic dictionary saves, window by window."""
        toxic, ordinary = self.packers
        return np.array([len(ordinary.compress(x)) - len(toxic.compress(x)) for x in windows(text)], np.float64)

    def facts(self, d: np.ndarray) -> np.ndarray:
        """Of what the windows of a text save: mean, largest, mean of the three largest, windows beyond the middle threshold
        up to three, and shares of windows beyond each threshold."""
        if not len(d):
            return np.zeros(4 + len(self.thresholds))
        middle = self.thresholds[len(self.thresholds) // 2]
        return np.array([d.mean(), d.max(), np.sort(d)[-3:].mean(), min(3, np.sum(d >= middle)), *[np.mean(d >= x) for x in self.thresholds]])

    def calibrate(self, texts: list[bytes], y: np.ndarray) -> None:
        """Set the thresholds, and fit the weights of the facts by logistic regression (Newton steps, slight ridge)."""
        saved = [self.saved(t) for t in texts]
        gains = np.concatenate([d[d > 0] for d in saved])
        self.thresholds = np.quantile(gains, QUANTILES, method="higher") if len(gains) else np.ones(len(QUANTILES))
        x = np.array([self.facts(d) for d in saved])
        self.mean, self.spread = x.mean(0), x.std(0) + 1e-9
        x = np.c_[(x - self.mean) / self.spread, np.ones(len(x))]
        w, ridge = np.zeros(x.shape[1]), 0.1 * np.eye(x.shape[1])
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w += np.clip(np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w), -2, 2)
        self.weights = w

    def score(self, text: bytes) -> float:
        if self.weights is None:
            return self.share
        x = np.append((self.facts(self.saved(text)) - self.mean) / self.spread, 1.0)
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30))))


def fit(labelled: DataFrame, seed: int = 5) -> Model:
    """A model of a bounded sample of (text, label 0 or 1), collected to the driver. Half of the texts make the
    dictionaries, half calibrate the score. Without texts of both labels every score is the share of label 1, 0 without rows."""
    rows = labelled.where("label in (0, 1)").select(F.col("text").cast("binary").alias("text"), "label").collect()
    rows.sort(key=lambda r: (bytes(r.text or b""), r.label))
    np.random.default_rng(seed).shuffle(rows)
    texts, y = [bytes(r.text or b"") for r in rows], np.array([r.label for r in rows])
    if len(set(y.tolist())) < 2:
        return Model(b"", b"", share=float(y.mean()) if len(y) else 0.0)
    half = len(texts) // 2
    model = Model(*dictionaries([t for t, x in zip(texts[:half], y) if x], [t for t, x in zip(texts[:half], y) if not x], seed))
    model.start()
    model.calibrate(texts[half:], y[half:])
    del model.packers
    return model


def score(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` and the score of every row; null and empty texts are scored as texts without windows."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    schema = df.select(*keep).schema.add("score", "double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = sent.value
        one.start()
        for batch in batches:
            found = [one.score(t.as_py() or b"") for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.float64())], names=schema.names)

    return df.select(*keep, F.col(text).cast("binary").alias("scored_text")).mapInArrow(scored, schema)
