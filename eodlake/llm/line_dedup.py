"""Line dedup: lines whose word sets have a Jaccard similarity of 0.8 or more with an earlier line go.

An exact set-similarity join: words of a line are ordered by rarity, lines that share a word of their prefixes meet
in that word's group, and pass the length and positional filters there. A 128-bit parity sketch of each set bounds
the distance of two sets from below, so pairs of unlike lines are dropped unseen by the rest, and no like ones are.
Each group names a few earlier lines for each line, the nearest by sketch among them, so groups of copies don't give all
their pairs; the Jaccard similarity of what is named is computed. Only lines that it leaves open, having more lines to
compare with and no match yet, meet all of theirs.

Every line with a word takes part. Sets of up to three words match equal ones only (at 0.8): their class settles them,
and they have no prefixes.

Later means a larger (document id, line number). A line goes if any earlier line matches it, itself removed
or not, so the result doesn't depend on the order of the work.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eodlake.llm.common import cut, fresh, row_keys
from eodlake.llm.setjoin import (
    CACHED_WORDS, LEVEL_BITS, MIX, SetJoin, Sets, Splitter, WordHashes, _chunks, counted_tokens, distinct, level, mixed, salts, sort_each,
)
from eodlake.session import Scratch

NUM, DEN = 4, 5
#: Every line with a word takes part.
MIN_WORDS = 1
BITS = 21
#: The group of a word that more prefixes hold is split: every two of its parts meet in a group of their own.
GROUP_ROWS = 50_000
#: Places and words that are wanted again are marked in bitmaps of at most so many bits; false marks only cost time.
MARK_BITS, TOKEN_BITS = 28, 22
#: So many earlier lines are named for a line in each group, besides the nearest.
NAMED = 3
BATCH_ROWS = 100_000
#: Prefix rows of open lines that every task may hold; more of them are shuffled to their groups. So many documents may be picked by their keys.
OPEN_ROWS = 100_000
#: Tokens of open lines are told by so many bits of theirs first.
KNOWN_BITS = 20
#: Over so many tasks the rows of a frequent token are spread until its prefix rows are counted.
SPREAD = 64
#: So many pairs are held against each other at a time.
PAIRS = 1_000_000
#: Counters travel in slices of 2^16.
SLICE_BITS = 16
#: A class of equal sets: 64 bits of a digest and the 128 bits of the sketch.
CLASS = ("c1", "s1", "s2")
#: Where a line stands: the key of its document and its number.
PLACE = ("id", "record")
PAIR = ("b_id", "b_record", "a_id", "a_record")
#: What a prefix row holds besides its token, packed into one column.
BODY = np.dtype([(k, "<i8") for k in ("id", *CLASS)] + [(k, "<i4") for k in ("record", "n", "at")])
READ = pa.schema([("id", pa.int64()), ("record", pa.int32()), *((k, pa.int64()) for k in CLASS), ("slice", pa.int32()), ("counts", pa.binary())])


def line_sets(min_words: int = MIN_WORDS) -> Splitter:
    """The word sets of the lines of each text, numbered from 0; A-Z in lower case."""
    hashes = WordHashes()

    def split(texts: list[bytes]) -> Sets:
        raw = b"\n".join(texts).lower()
        starts, h = hashes.of(raw)
        breaks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
        # Lines of all texts are numbered through; the first one of each text takes its number from the breaks before it.
        line = np.searchsorted(breaks, starts)
        text_start = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
        first = np.searchsorted(breaks, text_start)
        lines, n = np.unique(line, return_counts=True)
        long = n >= min_words
        h = h[np.repeat(long, n)]
        lines, n = lines[long], n[long]
        text = np.searchsorted(first, lines, side="right") - 1
        sizes, tokens = distinct(h, n)
        return Sets(text, lines - first[text], sizes, tokens)

    return split


def sketches(sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    """The parity of how many tokens of each set fall on each of 128 bits; two sketches differ in no more bits than their sets in tokens."""
    if not len(sets.size):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spot = mixed(sets.tokens + MIX[2]) >> np.uint64(57)
    bit, starts = np.uint64(1) << (spot & np.uint64(63)), sets.ends - sets.size
    return tuple(np.bitwise_xor.reduceat(np.where(spot >> np.uint64(6) == half, bit, np.uint64(0)), starts).view(np.int64) for half in (0, 1))


def others_match(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which set sizes another set can be similar to: one more token must leave the similarity. Smaller sets only match equal ones."""
    return (n > 0) & (n * den >= (n + 1) * num)


def one_each(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The first row of each class of each group, in order of the group and of n."""
    order = np.lexsort((rows["record"], rows["id"], rows["c1"], rows["n"], rows["token"]))
    rows = {k: v[order] for k, v in rows.items()}
    again = np.zeros(len(order), bool)
    again[1:] = np.logical_and.reduce([rows[k][1:] == rows[k][:-1] for k in ("token", "n", *CLASS)])
    return {k: v[~again] for k, v in rows.items()}


def nearest(rows: dict[str, np.ndarray], num: int, den: int) -> dict[str, np.ndarray]:
    """Earlier rows of its group that a row may match: the nearest by sketch, NAMED others at most, and whether there are more.

    Rows lie group by group, see `LineJoin.prefixes`. Memory is linear in them, whatever a group holds.
    """
    token = rows["token"]
    alone = np.ones(len(token), bool)
    alone[1:] &= token[1:] != token[:-1]
    alone[:-1] &= token[1:] != token[:-1]
    rows = one_each({k: v[~alone] for k, v in rows.items()})
    group, n, at, place, record, s1, s2 = (rows[k] for k in ("token", "n", "at", "id", "record", "s1", "s2"))
    s1, s2 = s1.view(np.uint64), s2.view(np.uint64)
    size, left = len(n), n - at
    best, by, more, count = np.full(size, 1 << 30), np.full(size, -1), np.zeros(size, bool), np.zeros(size, np.int64)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    i, step = np.arange(size), 1
    while len(i):
        # Of rows in order of n, each meets the one that many steps on, until that is too long or of another group.
        i = i[i + step < size]
        j = i + step
        fits = (group[i] == group[j]) & (n[i] * den >= n[j] * num)
        i, j = i[fits], j[fits]
        both, apart = n[i] + n[j], np.bitwise_count(s1[i] ^ s1[j]).astype(np.int64) + np.bitwise_count(s2[i] ^ s2[j])
        hit = (apart * (num + den) <= both * (den - num)) & (np.minimum(left[i], left[j]) * (num + den) >= both * num)
        if hit.any():
            a, b, apart = i[hit], j[hit], apart[hit]
            before = (place[a] < place[b]) | (place[a] == place[b]) & (record[a] < record[b])
            for later, early, these in ((b, a, before), (a, b, ~before)):
                later, early, d = later[these], early[these], apart[these]
                closer = d < best[later]
                best[later[closer]], by[later[closer]] = d[closer], early[closer]
                few = count[later] < NAMED
                pairs.append((later[few], early[few]))
                more[later[~few]] = True
                count[later] += 1
        step += 1
    far = np.flatnonzero(count > NAMED)
    later = np.concatenate([far, *(p[0] for p in pairs)]).astype(np.int64)
    early = np.concatenate([by[far], *(p[1] for p in pairs)]).astype(np.int64)
    sides = (("b", later), ("a", early))
    return {f"{side}_{k}": rows[k][which].astype(np.int64) for side, which in sides for k in PLACE} | {"more": more[later].astype(np.int64)}


def all_near(rows: dict[str, np.ndarray], asked: np.ndarray, num: int, den: int) -> dict[str, np.ndarray]:
    """PAIR: for each row that is asked for, all earlier ones of its group that it may match. Rows are those of `one_each`.

    Only rows asked for are held against their group: work and memory are linear in a group for each of them.
    """
    token, n, place, record = (rows[k] for k in ("token", "n", "id", "record"))
    s1, s2, left = rows["s1"].view(np.uint64), rows["s2"].view(np.uint64), rows["n"] - rows["at"]
    starts = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(token))
    later, early = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for b in np.flatnonzero(asked).tolist():
        g = int(np.searchsorted(starts, b, "right")) - 1
        of = slice(int(starts[g]), int(ends[g]))
        low, high = np.searchsorted(n[of], [-(-n[b] * num // den), n[b] * den // num + 1])
        of = slice(of.start + int(low), of.start + int(high))
        apart = np.bitwise_count(s1[of] ^ s1[b]).astype(np.int64) + np.bitwise_count(s2[of] ^ s2[b])
        both = n[of] + n[b]
        before = (place[of] < place[b]) | (place[of] == place[b]) & (record[of] < record[b])
        hit = before & (apart * (num + den) <= both * (den - num)) & (np.minimum(left[of], left[b]) * (num + den) >= both * num)
        a = np.flatnonzero(hit) + of.start
        early.append(a)
        later.append(np.full(len(a), b))
    sides = (("b", np.concatenate(later)), ("a", np.concatenate(early)))
    return {f"{side}_{k}": rows[k][which].astype(np.int64) for side, which in sides for k in PLACE}


class OpenRows:
    """Prefix rows of open lines, to hold against the rows of other lines where these are listed. Tokens are whole ones."""

    def __init__(self, rows: dict[str, np.ndarray], num: int, den: int):
        order = np.lexsort((rows["n"], rows["token"]))
        self.rows, self.num, self.den = {k: v[order] for k, v in rows.items()}, num, den
        self.tokens, group = np.unique(self.rows["token"], return_inverse=True)
        self.step = int(rows["n"].max()) + 2  # beyond any size
        self.keys = group * self.step + self.rows["n"]
        self.bits = np.zeros(1 << KNOWN_BITS, bool)
        self.bits[self.tokens & (1 << KNOWN_BITS) - 1] = True

    def near(self, sets: Sets) -> Sets:
        """The sets that may have a token of an open line, told by its last bits, which ranking leaves as they are."""
        last = (sets.tokens >> np.uint64(LEVEL_BITS + 1) & np.uint64((1 << KNOWN_BITS) - 1)).astype(np.int64)
        here = np.zeros(len(sets.size), bool)
        here[np.searchsorted(sets.ends, np.flatnonzero(self.bits[last]), "right")] = True
        return Sets(sets.text[here], sets.number[here], sets.size[here], sets.tokens[np.repeat(here, sets.size)])

    def known(self, tokens: np.ndarray) -> np.ndarray:
        """Which tokens open lines have, too."""
        return self.tokens[np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)] == tokens

    def later(self, rows: dict[str, np.ndarray]) -> Iterator[dict[str, np.ndarray]]:
        """PAIR and the class of a: the open lines b that come after a line a of `rows` and may match it. All tokens are known ones."""
        num, den, own, top = self.num, self.den, self.rows, self.step - 1
        base, n = np.searchsorted(self.tokens, rows["token"]) * self.step, rows["n"].astype(np.int64)
        low = np.searchsorted(self.keys, base + np.minimum(-(-n * num // den), top))
        count = np.searchsorted(self.keys, base + np.minimum(n * den // num, top), "right") - low
        ends = np.cumsum(count)
        cuts = np.unique(np.append(np.searchsorted(ends, np.arange(PAIRS, ends[-1], PAIRS)) if len(ends) else 0, [0, len(count)]))
        for i, j in itertools.pairwise(cuts.tolist()):
            c = count[i:j]
            a = np.repeat(np.arange(i, j), c)
            b = np.repeat(low[i:j] - np.cumsum(c) + c, c) + np.arange(len(a))
            both = n[a] + own["n"][b]
            before = (rows["id"][a] < own["id"][b]) | (rows["id"][a] == own["id"][b]) & (rows["record"][a] < own["record"][b])
            hit = before & (np.minimum(n[a] - rows["at"][a], own["n"][b] - own["at"][b]) * (num + den) >= both * num)
            a, b, both = a[hit], b[hit], both[hit]
            apart = sum(np.bitwise_count(rows[k][a].view(np.uint64) ^ own[k][b].view(np.uint64)).astype(np.int64) for k in ("s1", "s2"))
            hit = apart * (num + den) <= both * (den - num)
            sides = (("b", own, b[hit]), ("a", rows, a[hit]))
            yield {f"{side}_{k}": of[k][x].astype(np.int64) for side, of, x in sides for k in PLACE} | {k: rows[k][a[hit]] for k in CLASS}


def _spots(id_: np.ndarray, record: np.ndarray, bits: int) -> np.ndarray:
    """The place of a line as one of 2^bits bits."""
    return (mixed(mixed(id_.astype(np.int64).view(np.uint64) + MIX[0]) + record.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _first_here(seen: dict, one: np.ndarray, two: np.ndarray, id_: np.ndarray, record: np.ndarray) -> np.ndarray:
    """Which lines have no earlier one of equal words in this task, as far as it remembers."""
    first = np.ones(len(one), bool)
    for i, (a, b, *place) in enumerate(zip(one.tolist(), two.tolist(), id_.tolist(), record.tolist(), strict=True)):
        known = seen.get((a, b))
        if known is not None and known < tuple(place):
            first[i] = False
        else:
            if len(seen) >= CACHED_WORDS:
                seen.clear()
            seen[a, b] = tuple(place)
    return first


def _bodies(columns: dict[str, np.ndarray]) -> pa.Array:
    """The columns of BODY as one binary column."""
    size = len(columns["id"])
    body = np.empty(size, BODY)
    for k in BODY.names:
        body[k] = columns[k]
    ends = np.arange(size + 1, dtype=np.int32) * BODY.itemsize
    return pa.Array.from_buffers(pa.binary(), size, [None, pa.py_buffer(ends), pa.py_buffer(body)])


def _columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """The tokens of a batch of `LineJoin.prefixes`, and the columns of BODY."""
    bodies = batch.column(1)
    start = int(np.frombuffer(bodies.buffers()[1], np.int32, 1, bodies.offset * 4)[0])
    body = np.frombuffer(bodies.buffers()[2], BODY, len(bodies), start)
    return {"token": batch.column(0).to_numpy()} | {k: body[k].astype(np.int64) for k in BODY.names}


class LineJoin(SetJoin):
    """The join of the lines of some documents; a line is known by its place, a class of equal sets by the first one."""

    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        """One pass lists the lines and counts their tokens."""
        splitter, bits = self.splitter, self.bits

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            split, seen, counts = splitter(), {}, np.zeros(1 << bits, np.int64)
            for ids, texts in _chunks(batches):
                sets = split(texts)
                if not len(sets.size):
                    continue
                counts += counted_tokens(sets, bits)
                one, (s1, s2), own = sets.digests()[0], sketches(sets), np.array(ids, np.int64)[sets.text]
                again = pa.array(~_first_here(seen, one, s1, own, sets.number))
                known = [pc.if_else(again, None, pa.array(x)) for x in (one, s1, s2)]
                empty = [pa.nulls(len(own), t) for t in (pa.int32(), pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sets.number.astype(np.int32)), *known, *empty], schema=READ)
            for k in range(len(counts) >> SLICE_BITS):
                part = counts[k << SLICE_BITS : (k + 1) << SLICE_BITS]
                if part.any():
                    row = {f.name: [None] for f in READ} | {"slice": [k], "counts": [part.astype("<i8").tobytes()]}
                    yield pa.RecordBatch.from_pydict(row, schema=READ)

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}  # 2^bits numbers at most
            for batch in batches:
                for k, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    n = sums.setdefault(k, np.zeros(1 << SLICE_BITS, np.int64))
                    n += np.frombuffer(part.as_py(), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([level(n).tobytes() for n in sums.values()], pa.binary())], names=["slice", "levels"])

        fields = "id long, record int, c1 long, s1 long, s2 long, slice int, counts binary"
        self.read = self.scratch.write(self.texts.mapInArrow(read, fields))
        counters = self.read.where("slice is not null").select("slice", "counts").repartition("slice")
        table = np.zeros(1 << bits, np.uint8).reshape(-1, 1 << SLICE_BITS)
        for row in counters.mapInArrow(summed, "slice int, levels binary").collect():  # 2^bits bytes at most
            table[row.slice] = np.frombuffer(row.levels, np.uint8)
        return table.ravel(), salts()

    def copies(self) -> DataFrame:
        """(id, record) of every line with an earlier one of equal words. Each task lists few lines of a class, so no class is hot."""
        lines = self.read.where("slice is null")
        first = F.min(F.struct(*PLACE)).over(Window.partitionBy(*CLASS))
        later = lines.where("c1 is not null").select(*PLACE, first.alias("first")).where(F.struct(*PLACE) != F.col("first"))
        return lines.where("c1 is null").select(*PLACE).union(later.select(*PLACE))

    def marked(self, places: DataFrame) -> tuple[np.ndarray, int]:
        """The places (id, record) as a bitmap and its bits: 16 or more times their number, up to 2^MARK_BITS."""
        bits = min(MARK_BITS, max(16, (16 * places.count()).bit_length()))

        def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"spot": _spots(batch.column(0).to_numpy(), batch.column(1).to_numpy(), bits).astype(np.int32)})

        words = places.mapInArrow(spots, "spot int").groupBy(F.expr("spot >> 6").alias("word")).agg(F.expr("bit_or(shiftleft(1L, spot & 63))").alias("bits"))
        words = words.toArrow()  # 2^(MARK_BITS - 6) numbers at most
        marks = np.zeros(1 << bits - 6, np.int64)
        marks[words["word"].to_numpy()] = words["bits"].to_numpy()
        return marks, bits

    def prefixes(
        self, texts: DataFrame | None = None, places: tuple[np.ndarray, int] | None = None, tokens: np.ndarray | None = None, packed_: bool = True, asked: OpenRows | None = None
    ) -> DataFrame:
        """The prefix of every class, once or more, by rarity of tokens: (token, body), or (token, *BODY) if not packed.

        Only of some texts, of the lines at marked places, and only the marked tokens, where these are given. Within a task, a class
        is listed once while it is remembered, and again when it comes at an earlier place. With `asked`, only what
        `OpenRows.later` gives is listed.
        """
        splitter, ranked, num, den = self.splitter, self.ranked, self.num, self.den
        texts = self.texts if texts is None else texts
        wanted = self.spark.sparkContext.broadcast((places, tokens, asked))

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            split, seen = splitter(), {}
            places, tokens, asked = wanted.value
            for ids, texts in _chunks(batches):
                sets = split(texts) if asked is None else asked.near(split(texts))
                one, (s1, s2), n, own = sets.digests()[0], sketches(sets), sets.size, np.array(ids, np.int64)[sets.text]
                new = _first_here(seen, one, s1, own, sets.number) & others_match(n, num, den)
                if places is not None:
                    new &= _among(places, _spots(own, sets.number, places[1]))
                value = ranked(sets.tokens[np.repeat(new, n)])
                own, number, one, s1, s2, n = (x[new] for x in (own, sets.number, one, s1, s2, n))
                value = sort_each(value, n)
                record = np.repeat(np.arange(len(n)), n)
                at = np.arange(len(value)) - np.repeat(np.cumsum(n) - n, n)
                keep = at < (n - -(-num * n // den) + 1)[record]
                record, value, at = record[keep], value[keep], at[keep]
                columns = {"id": own, "c1": one, "s1": s1, "s2": s2, "record": number.astype(np.int32), "n": n.astype(np.int32)}
                if asked is not None:
                    keep = asked.known(value.view(np.int64))
                    rows = {"token": value[keep].view(np.int64), "at": at[keep]} | {k: v[record[keep]] for k, v in columns.items()}
                    for found in asked.later(rows):
                        yield pa.RecordBatch.from_pydict(found)
                    continue
                if tokens is not None:
                    keep = _among((tokens, TOKEN_BITS), (mixed(value) >> np.uint64(64 - TOKEN_BITS)).astype(np.int64))
                    record, value, at = record[keep], value[keep], at[keep]
                for i in range(0, len(record), BATCH_ROWS):
                    here = record[i : i + BATCH_ROWS]
                    body = {k: v[here] for k, v in columns.items()} | {"at": at[i : i + BATCH_ROWS].astype(np.int32)}
                    token = pa.array(value[i : i + BATCH_ROWS].view(np.int64))
                    if packed_:
                        yield pa.RecordBatch.from_arrays([token, _bodies(body)], names=["token", "body"])
                    else:
                        yield pa.RecordBatch.from_arrays([token, *(pa.array(body[k]) for k in BODY.names)], names=["token", *BODY.names])

        if asked is not None:
            return texts.mapInArrow(listed, ", ".join(f"{k} long" for k in (*PAIR, *CLASS)))
        return texts.mapInArrow(listed, "token long, body binary" if packed_ else "token long, id long, c1 long, s1 long, s2 long, record int, n int, at int")

    def grouped(self, prefixes: DataFrame, found: Callable[[dict[str, np.ndarray]], pa.RecordBatch], columns: tuple[str, ...]) -> DataFrame:
        """What `found` gives (columns of long) of the rows of whole groups of tokens, some groups at a time.

        A ranked token begins with its level. Those that at most about GROUP_ROWS lines have are groups at once; rows of others
        are spread and kept first, so that their prefixes are counted where they are few, and then meet by parts.
        """
        frequent = int(level(np.array([GROUP_ROWS]))[0]) + 1
        above = 63 - LEVEL_BITS

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[dict[str, np.ndarray]] = []
            for batch in batches:
                if not batch.num_rows:
                    continue
                held.append(_columns(batch))
                if sum(len(x["token"]) for x in held) >= BATCH_ROWS:
                    rows = {k: np.concatenate([x[k] for x in held]) for k in held[0]}
                    last = np.flatnonzero(rows["token"] != rows["token"][-1])
                    end = int(last[-1]) + 1 if len(last) else 0
                    if end:
                        yield found({k: v[:end] for k, v in rows.items()})
                    held = [{k: v[end:] for k, v in rows.items()}]
            if held:
                yield found({k: np.concatenate([x[k] for x in held]) for k in held[0]})

        def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept: list[pa.RecordBatch] = []

            def few() -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    # in order of tokens, frequent ones are last
                    n = int(np.searchsorted(batch.column(0).to_numpy(), frequent << above))
                    if n < batch.num_rows:
                        kept.append(batch.slice(n))
                    yield batch.slice(0, n)
                    if kept:
                        return

            for batch in each(few()):
                empty = [pa.nulls(batch.num_rows, t) for t in (pa.int64(), pa.binary())]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *empty], names=[*columns, "token", "body"])
            for batch in itertools.chain(kept, batches):
                empty = [pa.nulls(batch.num_rows, pa.int64())] * len(columns)
                yield pa.RecordBatch.from_arrays([*empty, *batch.columns], names=[*columns, "token", "body"])

        longs = ", ".join(f"{k} long" for k in columns)
        salt = F.when(F.shiftright("token", above) >= frequent, F.crc32("body") % SPREAD).otherwise(0)
        first = prefixes.repartition("token", salt).sortWithinPartitions("token").mapInArrow(rare, f"{longs}, token long, body binary")
        first = self.scratch.write(first)
        done, left = first.where("body is null").select(*columns), first.where("body is not null").select("token", "body")
        sizes = left.groupBy("token").count().orderBy("token").toArrow()  # tokens that more than GROUP_ROWS words are
        if not sizes.num_rows:
            return done
        wanted = self.spark.sparkContext.broadcast((sizes["token"].to_numpy(), -(-sizes["count"].to_numpy() // GROUP_ROWS)))

        def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tokens, parts = wanted.value
            for batch in batches:
                rows = _columns(batch)
                split_to = parts[np.searchsorted(tokens, rows["token"])]
                # A row goes to the groups in which its part meets each of the others.
                which = np.repeat(np.arange(len(split_to)), split_to)
                other = np.arange(len(which)) - np.repeat(np.cumsum(split_to) - split_to, split_to)
                value, split_to = rows["token"][which].view(np.uint64), split_to[which]
                mine = (rows["c1"][which] & 0x7FFFFFFF) % split_to
                low, high = np.minimum(mine, other), np.maximum(mine, other)
                part = np.where(split_to > 1, 1 + low * split_to + high, 0).astype(np.uint64)
                keep = (split_to == 1) | (mine != other)
                value = np.where(part > 0, mixed(value + part * MIX[0]), value)[keep].view(np.int64)
                bodies = batch.column(1).take(pa.array(which[keep]))
                for i in range(0, len(value), BATCH_ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array(value[i : i + BATCH_ROWS]), bodies.slice(i, BATCH_ROWS)], names=["token", "body"])

        together = left.mapInArrow(parted, "token long, body binary").repartition("token").sortWithinPartitions("token")
        return done.union(together.mapInArrow(each, longs))

    def of(self, places: DataFrame) -> DataFrame:
        """The texts that `places` (id, ...) lie in, or all if they lie in many."""
        ids = places.select("id").distinct()
        if ids.limit(OPEN_ROWS + 1).count() > OPEN_ROWS:
            return self.texts
        return self.texts.join(F.broadcast(ids), "id", "left_semi")

    def named(self) -> DataFrame:
        """(b_*, a_*, more): places of classes b and of earlier ones that they may match, and whether b has others."""
        num, den = self.num, self.den
        each = self.grouped(self.prefixes(), lambda rows: pa.RecordBatch.from_pydict(nearest(rows, num, den)), (*PAIR, "more"))
        return each.groupBy(*PAIR).agg(F.max("more").alias("more"))

    def similar(self, pairs: DataFrame) -> DataFrame:
        """(id, record): the places b of the rows of `pairs` (PAIR) whose sets have the similarity."""
        splitter, ranked = self.splitter, self.ranked
        places = [pairs.select(*(F.col(f"{side}_{k}").alias(k) for k in PLACE)) for side in "ab"]
        places = self.scratch.write(places[0].union(places[1]).distinct())
        wanted = self.spark.sparkContext.broadcast(self.marked(places))

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            split = splitter()
            for ids, texts in _chunks(batches):
                sets = split(texts)
                own = np.array(ids, np.int64)[sets.text]
                here = _among(wanted.value, _spots(own, sets.number, wanted.value[1]))
                ends = np.concatenate([[0], np.cumsum(sets.size[here])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ranked(sets.tokens[np.repeat(here, sets.size)]).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(own[here]), pa.array(sets.number[here].astype(np.int64)), lists], names=[*PLACE, "words"])

        sets = self.scratch.write(self.of(places).mapInArrow(listed, "id long, record long, words array<long>"))
        joined = pairs.select(*PAIR)
        for side in "ab":
            own = sets.select(*(F.col(k).alias(f"{side}_{k}") for k in PLACE), F.col("words").alias(f"{side}_words"))
            joined = joined.join(own, [f"{side}_{k}" for k in PLACE])
        shared, both = F.size(F.array_intersect("a_words", "b_words")), F.size("a_words") + F.size("b_words")
        return joined.where(shared * (self.num + self.den) >= both * self.num).select(F.col("b_id").alias("id"), F.col("b_record").alias("record")).distinct()

    def met(self, open_: DataFrame) -> DataFrame:
        """PAIR: all earlier classes that may match each class at the places `open_`.

        While their prefixes are few, the tasks that list the texts hold them, and nothing but pairs is shuffled.
        """
        marks = self.marked(open_)
        places = open_.select("id", F.col("record").cast("int").alias("record"))
        own = self.scratch.write(self.prefixes(texts=self.of(open_), places=marks, packed_=False).join(places, list(PLACE), "left_semi"))
        if own.count() <= OPEN_ROWS:
            rows = own.toArrow()  # OPEN_ROWS at most
            asked = OpenRows({k: rows[k].to_numpy() for k in rows.column_names}, self.num, self.den)
            found = self.prefixes(asked=asked).groupBy("b_id", "b_record", *CLASS).agg(F.min(F.struct("a_id", "a_record")).alias("a"))
            return found.select("b_id", "b_record", "a.a_id", "a.a_record")

        def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"spot": (mixed(batch.column(0).to_numpy().view(np.uint64)) >> np.uint64(64 - TOKEN_BITS)).astype(np.int32)})

        tokens = np.zeros(1 << TOKEN_BITS - 6, np.int64)
        bits = own.select("token").mapInArrow(spots, "spot int").groupBy(F.expr("spot >> 6").alias("word")).agg(F.expr("bit_or(shiftleft(1L, spot & 63))").alias("bits")).toArrow()
        tokens[bits["word"].to_numpy()] = bits["bits"].to_numpy()
        wanted, num, den = self.spark.sparkContext.broadcast(marks), self.num, self.den

        def near(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
            rows = one_each(rows)
            asked = _among(wanted.value, _spots(rows["id"], rows["record"], wanted.value[1]))
            return pa.RecordBatch.from_pydict(all_near(rows, asked, num, den))

        pairs = self.grouped(self.prefixes(tokens=tokens), near, PAIR)
        # a mark may be that of another place
        return pairs.join(open_.select(*(F.col(k).cast("long").alias(f"b_{k}") for k in PLACE)), ["b_id", "b_record"], "left_semi").select(*PAIR).distinct()

    def matched(self) -> DataFrame:
        """(id, record): the first lines of the classes that an earlier one matches."""
        named = self.scratch.write(self.named())
        gone = self.scratch.write(self.similar(named))
        more = named.where("more > 0").select(F.col("b_id").alias("id"), F.col("b_record").alias("record")).distinct()
        open_ = self.scratch.write(more.join(gone, list(PLACE), "left_anti"))
        if open_.isEmpty():
            return gone
        return gone.union(self.similar(self.scratch.write(self.met(open_))))


def _among(marks: tuple[np.ndarray, int], spots: np.ndarray) -> np.ndarray:
    return (marks[0][spots >> 6] >> (spots & 63) & 1).astype(bool)


def _removed(keyed: DataFrame, key: str, text_col: str, min_words: int, num: int, den: int) -> DataFrame:
    """(id, record) of the removed lines. Rows have a key, and rows of one key have one text."""
    if not keyed.groupBy(key).count().where("count > 1").isEmpty():
        keyed = keyed.select(key, text_col).dropDuplicates([key])
    with Scratch(keyed.sparkSession, lean=True) as scratch:
        join = LineJoin(keyed, key, text_col, lambda: line_sets(min_words), num, den, BITS, scratch)
        return cut(join.copies().union(join.matched().select("id", F.col("record").cast("int"))))


def removed_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, num: int = NUM, den: int = DEN
) -> DataFrame:
    """(id, record): the numbers of the lines, from 0, that an earlier line matches.

    Lines are parts between line feeds. Null and empty texts have no lines to remove. Rows without an id count as the
    last of all. Rows that repeat an id, and rows without one, are documents of their own unless their texts are equal; equal
    rows are one document. An empty table gives no rows. Further columns are not read.
    """
    key = fresh(df, "line_key")
    numbered = row_keys(df.select(id_col, text_col), id_col, text_col, key)
    ids = numbered.select(F.col(id_col).cast("long").alias("own"), F.col(key).alias("id")).distinct()
    return _removed(numbered, key, text_col, min_words, num, den).join(ids, "id").select(F.col("own").alias("id"), "record")


def line_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_removed, removed): per row of `df`, its lines with a word, and the numbers of those removed.

    Nulls, repeated ids and empty tables as in `removed_lines`.
    """
    key = fresh(df, "line_key")
    numbered = row_keys(df.select(id_col, text_col), id_col, text_col, key)
    removed = _removed(numbered, key, text_col, MIN_WORDS, NUM, DEN).groupBy(F.col("id").alias("key")).agg(F.array_sort(F.collect_list("record")).alias("removed"))
    lines = F.filter(F.split(F.coalesce(text_col, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = numbered.select(F.col(key).alias("key"), F.col(id_col).cast("long").alias("id"), F.size(lines).cast("long").alias("n_lines"))
    return (
        counted.join(removed, "key", "left")
        .withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))
        .select("id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")
    )


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_chars: str | None = None) -> DataFrame:
    """`df` without the removed lines; documents that lose every line with a word go.

    Other columns stay as they are, but the one named by n_chars, which gets the new length. Texts that lose nothing
    stay byte for byte, null and empty ones included. Rows that repeat an id, and rows without one, are documents of
    their own unless their texts are equal; of equal ones all stay or all go.
    """
    key, gone = fresh(df, "line_key"), fresh(df, "removed_lines")
    numbered = row_keys(df, id_col, text_col, key)
    removed = _removed(numbered, key, text_col, MIN_WORDS, NUM, DEN).groupBy(F.col("id").alias(key)).agg(F.collect_list("record").alias(gone))
    lines = F.filter(F.split(text_col, "\n"), lambda _, i: ~F.array_contains(gone, i))
    joined = numbered.join(removed, key, "left")
    cleaned = joined.withColumn(text_col, F.when(F.col(gone).isNotNull(), F.array_join(lines, "\n")).otherwise(F.col(text_col)))
    kept = cleaned.where(F.col(gone).isNull() | F.col(text_col).rlike(r"[^\x20\x09-\x0D]"))
    if n_chars is not None:
        kept = kept.withColumn(n_chars, F.when(F.col(gone).isNotNull(), F.length(text_col)).otherwise(F.col(n_chars)).cast(df.schema[n_chars].dataType))
    return kept.select(*df.columns)
