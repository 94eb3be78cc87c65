"""Repeated byte strings across documents, found with suffix arrays (`suffix_array.py`).

A byte goes if a string of `length` bytes that covers it also starts in a document with a smaller id; matches never
cross documents. No suffix array over the whole corpus is needed, since equal strings can be brought together first:

1. Every string of `length` bytes has one anchor, the 16 bytes in it with the least hash (a minimizer), which depends on
   nothing but the string. Neighbouring strings of one anchor form a context of `length` to `length` + 34 bytes. A
   task hashes its documents block by block and sends one small row a context: hash of the anchor, hash of the
   context, document, place. Of equal contexts of a block only those of the smallest id are sent as open; the rest is
   decided. So a passage in a third of all documents reaches its key as one row a block.
2. Rows sorted by (anchor, context, id) are streamed: equal contexts beyond the smallest id are decided. An anchor
   with a single context is then settled. Contexts of the other anchors are cut out of the texts, one copy each.
3. These contexts, sorted by anchor, are packed into blocks of a few MB. Each block gets its suffix array by two-stage
   sorting and the common prefixes of neighbours; suffixes that agree on `length` bytes form a run, and all of the run but
   the smallest id is covered. An anchor whose contexts fill several blocks gets a further round over the hashes of the
   distinct strings of each block, so no group is ever held as a whole.

Rows with a null id are left as they are and take nothing from others. A null text is an empty one. Rows that
repeat an id are told apart by the hash of their text and take nothing from each other; ids that repeat only cost
time. Columns other than id and text are not read. Memory is a few blocks of 2 MB, apart from the text of one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eodlake.llm.common import cut, utf8
from eodlake.llm.suffix_array import common_prefixes, suffix_order
from eodlake.session import Scratch

LENGTH = 50
ANCHOR = 16
BLOCK = 1 << 21
_U = np.uint64
_BASES = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F))
_BYTES = np.random.default_rng(5).integers(1, 1 << 63, (2, 256), dtype=np.uint64) * _U(2) + _U(1)
_SEPARATOR = 255  # never a byte of UTF-8

#: `place` is where a span starts and how long it is, in one number: most of the shuffled bytes are these rows.
OPEN = "a long, e long, doc long, part long, place long, open boolean"
FOUND = "a long, doc long, part long, place long, covered boolean"
START, STOP = "cast(place >> 32 AS int)", "cast((place >> 32) + (place & 4294967295) AS int)"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def _place(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return start.astype(np.int64) << 32 | (stop - start).astype(np.int64)


class Hashes:
    """Hashes of any substring of a block from running sums of powers, the same wherever the substring lies."""

    _powers: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, text: np.ndarray, which: int):
        n, base = len(text), int(_BASES[which])
        # powers of the base and of its inverse, kept for the next block
        up, down = self._powers.get((which, 0), (np.ones(1, _U), np.ones(1, _U)))
        if len(up) <= n:
            size = max(n + 1, BLOCK + 1)
            up = np.multiply.accumulate(np.append(_U(1), np.full(size - 1, base, _U)))
            down = np.multiply.accumulate(np.append(_U(1), np.full(size - 1, pow(base, -1, 1 << 64), _U)))
            self._powers[which, 0] = up, down
        self._down = down
        self._sums = np.zeros(n + 1, _U)
        np.cumsum(_BYTES[which][text] * up[:n], out=self._sums[1:])

    def at(self, start, stop) -> np.ndarray:
        span = (self._sums[stop] - self._sums[start]) * self._down[start]
        return _mix(span + np.asarray(stop - start).astype(_U))


def merged(row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, stop): index of the first of each set of overlapping or touching spans of a row, and where that set stops.

    The spans come ordered by (row, start)."""
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    high = row.astype(np.int64) << 32
    reach = np.maximum.accumulate(high + stop)
    first = np.flatnonzero(np.append(True, (high + start)[1:] > reach[:-1]))
    last = np.append(first[1:], len(row)) - 1
    return first, reach[last] - high[last]


def contexts(text: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, context hash, start, stop) of a block of documents that end at `ends`, in order of place."""
    n, w = len(text), length - ANCHOR + 1
    none = np.zeros(0, _U), np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n < length:
        return none
    grams = Hashes(text, 0)
    at = np.arange(n - ANCHOR + 1)
    gram = grams.at(at, at + ANCHOR)
    bits = _U(n.bit_length())
    best = (gram >> bits << bits) | at.astype(_U)  # the leftmost of equal hashes
    span = 1
    while 2 * span <= w:  # least of `span` neighbours, doubled
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < w:
        best = np.minimum(best[: n - length + 1], best[w - span : w - span + n - length + 1])
    whole = np.ones(n - length + 1, bool)
    for end in ends[:-1]:
        whole[max(0, end - length + 1) : end] = False
    s = np.flatnonzero(whole)
    if not len(s):
        return none
    anchor = (best[s] & ((_U(1) << bits) - _U(1))).astype(np.int64)
    first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (s[1:] != s[:-1] + 1)))
    start, stop = s[first], s[np.append(first[1:], len(s)) - 1] + length
    return gram[anchor[first]], Hashes(text, 1).at(start, stop), start, stop


def _blocks(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first row, row behind the last, first byte, byte behind the last) of each block of rows; a row longer than a
    block comes in pieces that overlap by length - 1 bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, "right")) - 1)
        lo, hi = int(offsets[i]), int(offsets[j])
        if hi - lo <= BLOCK:
            yield i, j, lo, hi
        else:
            for at in range(lo, max(lo + 1, hi - length + 1), BLOCK - length + 1):
                yield i, j, at, min(hi, at + BLOCK)
        i = j


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, data) of a binary column without nulls."""
    wide = pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return offsets.astype(np.int64), np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def _batch(schema: str, *columns) -> pa.RecordBatch:
    names, kinds = zip(*[c.split() for c in schema.split(", ")], strict=True)
    types = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(np.asarray(c), types[k]) for c, k in zip(columns, kinds, strict=True)], names=list(names)
    )


def _covered(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of OPEN as covered ones, whose anchor no longer matters."""
    n = rows.num_rows
    return _batch(FOUND, np.zeros(n, np.int64), *rows.columns[2:5], np.ones(n, bool))


def _sent(doc: np.ndarray, part: np.ndarray, at: np.ndarray, text: np.ndarray, ends: np.ndarray, length: int) -> pa.RecordBatch | None:
    """The rows that a block sends. Its documents have the ids `doc`, begin at `at` and end at `ends`."""
    a, e, start, stop = contexts(text, ends, length)
    if not len(a):
        return None
    local = np.searchsorted(ends, start, "right")
    order = np.lexsort((start, local, doc[local], e, a))
    a, e, start, stop, local = (x[order] for x in (a, e, start, stop, local))
    ids = doc[local]
    group = np.cumsum(np.append(True, (a[1:] != a[:-1]) | (e[1:] != e[:-1]))) - 1
    least = ids[np.flatnonzero(np.diff(group, prepend=-1))][group]
    mine = np.flatnonzero(ids == least)
    # repeats of a context inside a document count once, as the spans they cover
    same = np.cumsum(np.append(True, (group[mine][1:] != group[mine][:-1]) | (local[mine][1:] != local[mine][:-1])))
    first, open_stop = merged(same, start[mine], stop[mine])
    mine = mine[first]
    # what is decided here travels along as spans, dealt by document
    rest = np.flatnonzero(ids != least)
    rest = rest[np.lexsort((start[rest], local[rest]))]
    first, done_stop = merged(local[rest], start[rest], stop[rest])
    rest = rest[first]
    pick = np.concatenate([mine, rest])
    n = len(mine)
    shift = at[local[pick]]
    return _batch(
        OPEN,
        np.append(a[mine], _mix(ids[rest].view(_U))).view(np.int64), np.append(e[mine], np.zeros(len(rest), _U)).view(np.int64),
        ids[pick], part[local[pick]], _place(start[pick] - shift, np.append(open_stop, done_stop) - shift), np.arange(len(pick)) < n,
    )


def _anchors(length: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, part = (np.asarray(batch.column(c)) for c in ("doc", "part"))
            offsets, data = _bytes_of(batch.column("text"))
            for i, j, lo, hi in _blocks(offsets, length):
                found = _sent(doc[i:j], part[i:j], offsets[i:j] - lo, data[lo:hi], np.minimum(offsets[i + 1 : j + 1], hi) - lo, length)
                if found is not None:
                    yield found

    return send


def _settle(branches: bool):
    """Rows sorted by (a, e, doc): covered ones, and of anchors with several contexts (`branches`) one of each context."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (a, e) of the row before, its least id
        seen = 0  # contexts of the last anchor so far
        waiting: list[pa.RecordBatch] = []  # its rows, as long as there is one context
        for batch in batches:
            decided = batch.filter(pa.compute.invert(batch.column("open")))
            if decided.num_rows:
                yield _covered(decided)
            batch = batch.filter(batch.column("open"))
            n = batch.num_rows
            if not n:
                continue
            a, e, doc = (np.asarray(batch.column(i)) for i in range(3))
            before = last or (a[0] + 1, 0, 0)
            new_a = np.append(a[0] != before[0], a[1:] != a[:-1])
            new_e = new_a | np.append(e[0] != before[1], e[1:] != e[:-1])
            group = np.cumsum(new_e)
            least = np.append(before[2], doc[new_e])[group]
            covered = doc > least
            if covered.any():
                yield _covered(batch.filter(pa.array(covered)))
            if branches:
                anchor = np.cumsum(new_a)  # 0: goes on from the batch before
                kinds = np.bincount(anchor, new_e).astype(np.int64)
                kinds[0] += seen
                if waiting and kinds[0] > 1:
                    yield from waiting
                if len(kinds) > 1 or kinds[0] > 1:
                    waiting = []
                left = batch.filter(pa.array(~covered))
                kept = _batch(FOUND, left.column("a"), *left.columns[2:5], np.zeros(left.num_rows, bool))
                many = kinds[anchor[~covered]] > 1
                if many.any():
                    yield kept.filter(pa.array(many))
                seen = kinds[-1]
                if seen == 1:
                    waiting.append(kept.filter(pa.array(anchor[~covered] == anchor[-1])))
            last = (a[-1], e[-1], least[-1])

    return settle


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted contexts of each text."""
    for batch in batches:
        offsets, data = _bytes_of(batch.column("text"))
        wanted = batch.column("wanted")
        local = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(wanted.offsets)))
        a, start, stop = (np.asarray(x) for x in wanted.flatten().flatten())
        lo = offsets[local] + start
        held = np.concatenate([[0], np.cumsum(stop - start)])
        at = np.repeat(lo - held[:-1], stop - start) + np.arange(held[-1])
        text = pa.Array.from_buffers(pa.large_binary(), len(a), [None, pa.py_buffer(held.tobytes()), pa.py_buffer(data[at].tobytes())]).cast(pa.binary())
        doc, part = (np.asarray(batch.column(c))[local] for c in ("doc", "part"))
        yield _batch("a long, doc long, part long, start int, text binary", a, doc, part, start, text)


def _same_strings(block: list[tuple], length: int, split: int | None) -> Iterator[pa.RecordBatch]:
    """Covered spans of the contexts of a block, and of the anchor `split`, which goes on in other blocks, the
    distinct strings as open rows."""
    a, doc, part, start, sizes = (np.concatenate(x) for x in list(zip(*block, strict=True))[:5])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    text = np.full(int((sizes + 1).sum()), _SEPARATOR, np.uint8)
    inside = np.ones(len(text), bool)
    inside[begins + sizes] = False
    text[inside] = np.concatenate([x[5] for x in block])
    order = suffix_order(text, length)
    owner = np.repeat(np.arange(len(a)), sizes + 1)
    at = order - begins[owner[order]]
    order = order[at + length <= sizes[owner[order]]]
    owner = owner[order]
    place = start[owner] + order - begins[owner]
    run = np.cumsum(common_prefixes(text, order, length) < length) - 1
    least = np.minimum.reduceat(doc[owner], np.flatnonzero(np.diff(run, prepend=-1)))[run]
    covered = np.flatnonzero(doc[owner] > least)
    covered = covered[np.lexsort((place[covered], owner[covered]))]
    first, stop = merged(owner[covered], place[covered], place[covered] + length)
    pick = covered[first]
    yield _batch(OPEN, np.zeros(len(pick)), np.zeros(len(pick)), doc[owner[pick]], part[owner[pick]], _place(place[pick], stop), np.zeros(len(pick), bool))
    if split is not None:
        left = np.flatnonzero((doc[owner] == least) & (a[owner] == split))
        one, two = (Hashes(text, i).at(order[left], order[left] + length).view(np.int64) for i in (0, 1))
        yield _batch(OPEN, one, two, doc[owner[left]], part[owner[left]], _place(place[left], place[left] + length), np.ones(len(left), bool))


def _sort_suffixes(length: int, size: int):
    """Contexts sorted by anchor, in blocks of about `size` bytes that end where an anchor ends if they can."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, carried = [], 0, None
        for batch in batches:
            offsets, data = _bytes_of(batch.column("text"))
            columns = [np.asarray(batch.column(i)) for i in range(4)]
            sizes = np.diff(offsets)
            i = 0
            while i < batch.num_rows:
                a = int(columns[0][i])
                j = int(np.searchsorted(columns[0][i:], a, "right")) + i
                if carried is not None and a != carried:  # the split anchor is over
                    yield from _same_strings(block, length, carried)
                    block, held, carried = [], 0, None
                elif held >= size:
                    same = a == int(block[-1][0][-1])
                    yield from _same_strings(block, length, a if same else None)
                    block, held, carried = [], 0, a if same else None
                # the rows of this anchor, as many as fit
                full = offsets[i:j] - offsets[i] + held >= size
                j = i + max(1, int(full.argmax()) if full.any() else j - i)
                block.append((*[c[i:j] for c in columns], sizes[i:j], data[offsets[i] : offsets[j]]))
                held += int(offsets[j] - offsets[i])
                i = j
        if block:
            yield from _same_strings(block, length, carried)

    return sort


def covered(docs: DataFrame, scratch: Scratch, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """(doc, part, start, stop) of the spans to remove, of `docs` (doc, part, text as bytes); ids not null."""
    known = docs.where("doc IS NOT NULL").where(F.length("text") >= length)
    sent = known.mapInArrow(_anchors(length), OPEN)
    found = scratch.write(sent.repartition("a").sortWithinPartitions("a", "e", "doc").mapInArrow(_settle(True), FOUND))
    wanted = F.collect_list(F.struct("a", F.expr(START).alias("start"), F.expr(STOP).alias("stop"))).alias("wanted")
    wanted = found.where("NOT covered").groupBy("doc", "part").agg(wanted)
    pieces = known.join(wanted, ["doc", "part"]).select("doc", "part", "text", "wanted").mapInArrow(
        _cut_out, "a long, doc long, part long, start int, text binary"
    )
    sorted_ = scratch.write(pieces.repartition("a").sortWithinPartitions("a").mapInArrow(_sort_suffixes(length, block), OPEN))
    split = sorted_.where("open").repartition("a").sortWithinPartitions("a", "e", "doc").mapInArrow(_settle(False), FOUND)
    spans = found.where("covered").select("doc", "part", "place").union(sorted_.where("NOT open").select("doc", "part", "place"))
    return spans.union(split.select("doc", "part", "place")).selectExpr("doc", "part", f"{START} AS start", f"{STOP} AS stop")


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = _bytes_of(batch.column("text"))
        spans = batch.column("spans")
        local = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(spans.offsets)))
        start, stop = (np.asarray(x).astype(np.int64) for x in spans.flatten().flatten())
        order = np.lexsort((start, local))
        local, start, stop = local[order], start[order], stop[order]
        first, stop = merged(local, start, stop)
        local, start = local[first], start[first]
        removed = np.bincount(local, stop - start, batch.num_rows).astype(np.int64)
        runs = np.bincount(local, minlength=batch.num_rows)
        # +1 where a removed run starts, -1 where it stops
        step = np.zeros(int(offsets[-1] - offsets[0]) + 1, np.int8)
        np.add.at(step, offsets[local] - offsets[0] + start, 1)
        np.add.at(step, offsets[local] - offsets[0] + stop, -1)
        kept = data[offsets[0] : offsets[-1]][np.cumsum(step[:-1], dtype=np.int8) == 0]
        held = np.concatenate([[0], np.cumsum(np.diff(offsets) - removed)])
        text = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(held.tobytes()), pa.py_buffer(kept.tobytes())])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array(np.diff(offsets)), pa.array(removed), pa.array(runs), text.cast(pa.binary())],
            names=["doc", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def remove_repeats(docs: DataFrame, id_: str = "doc_id", text: str = "text", length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """(doc, n_bytes, n_removed, n_spans, kept) of every row: sizes in bytes, maximal removed runs, and what is left.

    `kept` is binary, as a run may end inside a character. For nulls and repeated ids see above.
    """
    docs = docs.select(F.col(id_).cast("long").alias("doc"), utf8(text).alias("text"))
    # rows of one id are told apart by their text, where there are several
    again = cut(docs.where("doc IS NOT NULL").groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").select("doc", F.lit(True).alias("again")))
    if again.isEmpty():
        docs = docs.withColumn("part", F.lit(0).cast("long"))
    else:
        part = F.when(F.col("again"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
        docs = docs.join(again, "doc", "left").withColumn("part", part)
    with Scratch(docs.sparkSession, lean=True) as scratch:
        spans = cut(covered(docs, scratch, length, block).groupBy("doc", "part").agg(F.collect_list(F.struct("start", "stop")).alias("spans")))
    none = F.array().cast("array<struct<start:int,stop:int>>")
    return (
        docs.join(spans, ["doc", "part"], "left")
        .select("doc", "text", F.coalesce("spans", none).alias("spans"))
        .mapInArrow(_remove, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    )
