"""Quality rules as a short-circuit cascade: the rule that rejects most per second goes first.

Each rule's cost and share of rejections are measured on a seeded sample; the cascade then runs the
rules in the order of rejections per cost and stops at the first that rejects. A text passes when no
rule rejects it, so the order changes the time and never the verdict.
"""

from __future__ import annotations

import string
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eodlake.llm.common import fresh

SYMBOLS = b"#*$%&|<>"
SAMPLE_ROWS = 1000
WINDOW = 5


class Text:
    """One UTF-8 text and its facts, each counted when first asked for."""

    def __init__(self, raw: bytes):
        self.raw = raw

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        inside = np.frombuffer(b"".join(self.words), np.uint8)
        return int(np.count_nonzero((inside & 0xC0) != 0x80))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    @cached_property
    def worded_lines(self) -> list[bytes]:
        return [x for x in self.raw.split(b"\n") if x.split()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.worded_lines) - len(set(self.worded_lines))

    @cached_property
    def n_upper(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, string.ascii_uppercase.encode()))

    @cached_property
    def n_lower(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, string.ascii_lowercase.encode()))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside windows of five words that occur twice or more; exact, by ranks of pairs."""
        n = self.n_words
        if n <= WINDOW:
            return 0
        seen: dict[bytes, int] = {}
        one = np.fromiter((seen.setdefault(w, len(seen)) for w in self.words), np.int64, n)
        if len(seen) == n:
            return 0
        two = _ranks(one[:-1], one[1:])
        four = _ranks(two[:-2], two[2:])
        five = _ranks(four[:-1], one[4:])
        again = np.flatnonzero(np.bincount(five)[five] > 1)
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, again, 1)
        np.add.at(edge, again + WINDOW, -1)
        return int(np.count_nonzero(np.cumsum(edge)))


def _ranks(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1].ravel()


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


BASE_RULES = (
    Rule("few_words", lambda t: t.n_words < 10),
    Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > 20 * t.n_words),
)
RULES = (
    *BASE_RULES,
    Rule("many_symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("odd_word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 12 * t.n_words),
    Rule("repeated_lines", lambda t: 2 * t.n_dup_lines > len(t.worded_lines)),
    Rule("shouting", lambda t: t.n_upper > t.n_lower),
)


@dataclass(frozen=True)
class Measured:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def per_cost(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def measure(
    df: DataFrame, text: str, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS, seed: int = 7
) -> list[Measured]:
    """Seconds a text and share of rejections of each rule alone, over about `sample_rows` seeded rows.

    The sample only sets the order of the rules. An empty table gives zeros.
    """
    n = df.count()
    if not n:
        return [Measured(r, 0.0, 0.0) for r in rules]

    def timed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or b"" for x in batch.column(0).to_pylist()]
            seconds, rejected = [], []
            for rule in rules:
                began = time.perf_counter()
                rejected.append(sum(bool(rule.rejects(Text(x))) for x in texts))
                seconds.append(time.perf_counter() - began)
            yield pa.RecordBatch.from_pydict(
                {"rule": pa.array(range(len(rules)), pa.int32()), "seconds": seconds,
                 "rejected": pa.array(rejected, pa.int64()), "texts": pa.array([len(texts)] * len(rules), pa.int64())}
            )

    sample = df.select(F.col(text).cast("binary").alias("raw")).sample(min(1.0, sample_rows / n), seed)
    found = {
        r.rule: r
        for r in sample.mapInArrow(timed, "rule int, seconds double, rejected long, texts long")
        .groupBy("rule")
        .agg(F.sum("seconds").alias("s"), F.sum("rejected").alias("x"), F.sum("texts").alias("n"))
        .collect()
    }
    return [
        Measured(rule, found[i].s / found[i].n, found[i].x / found[i].n) if i in found else Measured(rule, 0.0, 0.0)
        for i, rule in enumerate(rules)
    ]


def ordered(measured: Sequence[Measured]) -> list[Rule]:
    """Rules by rejections per second, the largest first; equal ones as they were given."""
    return [m.rule for m in sorted(measured, key=lambda m: -m.per_cost)]


def cascade(
    df: DataFrame,
    text: str,
    rules: Sequence[Rule] = RULES,
    facts: Sequence[str] = (),
    verdict: str = "kept",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """All rows and columns of `df`, the named facts of each text as longs, and the verdict (true: kept).

    Null and empty texts have no words, and "few_words" rejects them. New columns whose names `df`
    already has get a `_` behind them. Rows don't influence each other, repeated ones included.
    """
    chosen = ordered(measure(df, text, rules, sample_rows))
    raw = fresh(df, "raw_text")
    schema = df.schema
    for name in facts:
        schema = schema.add(fresh(df, name), "long")
    schema = schema.add(fresh(df, verdict), "boolean")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in facts]
            kept = []
            for value in batch.column(batch.num_columns - 1).to_pylist():
                t = Text(value or b"")
                for out, name in zip(counts, facts, strict=True):
                    out.append(getattr(t, name))
                kept.append(not any(rule.rejects(t) for rule in chosen))
            columns = batch.columns[:-1] + [pa.array(x, pa.int64()) for x in counts] + [pa.array(kept, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.withColumn(raw, F.col(text).cast("binary")).mapInArrow(judged, schema)
