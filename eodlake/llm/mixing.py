"""Mixing sources to target weights as a min-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to. A pattern offers its words once at
cost 0, again at 1 and a third time at 2 (convex), and feeds the quotas of its sources. As only the
arcs out of the start cost anything, filling the cost levels one after the other by augmenting paths
gives the cheapest full flow. Documents are then taken in a seeded order, by exact running totals.
"""

from __future__ import annotations

import itertools
import math
from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eodlake.llm.common import WORD, cut

WEIGHTS = (5, 2, 1)
REPEATS = 3
#: Patterns are planned on the driver; beyond so many the operator refuses instead of filling it.
MAX_PATTERNS = 100_000


def text_size(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def seeded(seed: int, *columns: str) -> Column:
    """60 bits that depend on the seed and the row only."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(sizes: dict[str | None, int], total: int, weights: Sequence[int], repeats: int) -> dict[str | None, float]:
    """Shares of `total` by weight; what exceeds `repeats` times a source's size goes to the others."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = dict(zip(names, itertools.cycle(weights)))
    open_, found, left = list(names), {}, total
    while open_:
        whole = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] > repeats * sizes[s] * whole]
        if not over:
            return found | {s: left * weight[s] / whole for s in open_}
        found |= {s: float(repeats * sizes[s]) for s in over}
        left -= sum(repeats * sizes[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    return found


def route(patterns: dict[str, tuple[list, int]], quotas: dict, repeats: int) -> dict[str, dict]:
    """Words that each pattern sends to each of its sources, at the least cost of repetition.

    patterns: key -> (sources, words); quotas: source -> words. Breadth-first augmenting paths over
    patterns and sources, one cost level after the other.
    """
    sent = {p: dict.fromkeys(names, 0) for p, (names, _) in patterns.items()}
    into: dict = {s: [] for s in quotas}
    for p, (names, _) in patterns.items():
        for s in names:
            into[s].append(p)
    open_quota = dict(quotas)
    for _ in range(repeats):
        supply = {p: words for p, (_, words) in patterns.items()}
        while True:
            came: dict = {("p", p): None for p in supply if supply[p] > 0}
            queue, end = deque(came), None
            while queue and end is None:
                kind, name = node = queue.popleft()
                if kind == "p":
                    steps = [("s", s) for s in patterns[name][0]]
                elif open_quota[name] > 0:
                    end, steps = node, []
                else:
                    steps = [("p", p) for p in into[name] if sent[p][name] > 0]
                for step in steps:
                    if step not in came:
                        came[step] = node
                        queue.append(step)
            if end is None:
                break
            path = [end]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            path.reverse()
            back = [(path[i][1], path[i + 1][1]) for i in range(1, len(path) - 1, 2)]
            amount = min([supply[path[0][1]], open_quota[end[1]], *(sent[p][s] for s, p in back)])
            for i in range(0, len(path) - 1, 2):
                sent[path[i][1]][path[i + 1][1]] += amount
            for s, p in back:
                sent[p][s] -= amount
            supply[path[0][1]] -= amount
            open_quota[end[1]] -= amount
    return sent


def mix(
    df: DataFrame,
    size: Column,
    sources: Column,
    order: Column,
    tie: Sequence[str] = (),
    weights: Sequence[int] = WEIGHTS,
    repeats: int = REPEATS,
) -> DataFrame:
    """Every row of `df` under `row` (a struct of its columns), with what the mix takes of it.

    Further columns: size, source_size and target (arrays beside `sources`), taken (words, repeats
    counted), copies, and copies_by_source. `sources` is an array column; null or empty is the one source
    null. `order` is a 60-bit seeded number; equal ones are ordered by `tie`, then size. Rows that agree
    in all of these are alike, so a rerun gives the same rows. Sizes of 0 take nothing; an empty table
    gives no rows. Names of the input can't clash, as they stay inside `row`.

    The running totals are exact: totals of about sqrt(rows) ranges of the order, plus a window inside
    each range. The order is a hash, so no range holds a hot group, whatever the sources are.
    """
    n = df.count()
    bits = max(1, math.ceil(math.log2(max(2, n)) / 2))
    member = F.when(F.coalesce(F.size(sources), F.lit(0)) > 0, F.array_sort(F.array_distinct(sources))).otherwise(
        F.array(F.lit(None).cast("string"))
    )
    rows = df.select(
        F.struct(*df.columns).alias("row"),
        size.cast("long").alias("size"),
        member.alias("sources"),
        order.alias("order"),
    ).select(
        "*",
        F.to_json("sources").alias("pattern"),
        F.shiftright("order", 60 - bits).alias("range"),
    )
    ranges = cut(rows.groupBy("pattern", "range").agg(F.sum("size").alias("words"), F.first("sources").alias("sources")))
    if ranges.select("pattern").distinct().count() > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} combinations of sources")
    found = {
        r.pattern: (list(r.sources), int(r.words))
        for r in ranges.groupBy("pattern").agg(F.sum("words").alias("words"), F.first("sources").alias("sources")).collect()
    }
    sizes: dict[str | None, int] = {}
    for names, words in found.values():
        for s in names:
            sizes[s] = sizes.get(s, 0) + words
    want = targets(sizes, sum(w for _, w in found.values()), weights, repeats)
    sent = route(found, {s: math.floor(t + 0.5) for s, t in want.items()}, repeats)
    plan = df.sparkSession.createDataFrame(
        [
            (p, words, [sizes[s] for s in names], [want[s] for s in names], list(itertools.accumulate(sent[p][s] for s in names)))
            for p, (names, words) in found.items()
        ],
        "pattern string, whole long, source_size array<long>, target array<double>, upto array<long>",
    )
    ahead = Window.partitionBy("pattern").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("pattern", "range", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("offset"))
    inside = (
        Window.partitionBy("pattern", "range")
        .orderBy("order", *[F.col(f"row.{c}") for c in tie], "size")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    # A copy is taken when its middle lies below what the pattern sends, and goes to the source whose part it lies in.
    middles = F.transform(
        F.sequence(F.lit(0), F.lit(repeats - 1)),
        lambda k: k * F.col("whole") * 2 + F.col("upto_here") * 2 - F.col("size"),
    )
    placed = rows.join(offsets, ["pattern", "range"]).select(
        "*", (F.col("offset") + F.sum("size").over(inside)).alias("upto_here")
    )
    below = lambda upto: F.size(F.filter(middles, lambda m: m < upto * 2))
    return (
        placed.join(F.broadcast(plan), "pattern")  # at most MAX_PATTERNS rows
        .select("row", "size", "sources", "source_size", "target", F.transform("upto", below).alias("below"))
        .select(
            "row", "size", "sources", "source_size", "target",
            F.when(F.col("size") > 0, F.element_at("below", -1)).otherwise(0).alias("copies"),
            F.transform("below", lambda x, i: x - F.when(i > 0, F.get("below", i - 1)).otherwise(0)).alias("copies_by_source"),
        )
        .withColumn("taken", F.col("size") * F.col("copies"))
    )
