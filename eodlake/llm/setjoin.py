"""Exact joins of sets by Jaccard similarity: the steps that line dedup and the n-gram join share.

A record is a set of 64-bit tokens. Its class is the set itself (128-bit digest), so equal sets are one
record from the start. Tokens are ordered by rarity, then by hash; the order comes from a table of counts
of bounded size, so it fits every task whatever the corpus. Two sets that are similar enough share a token of their
prefixes (prefix filter). Hot tokens are split over salts of bounded size; each group first meets one
pivot, which is linear, and only what pivots leave open is joined pair by pair.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eodlake.session import Scratch

#: Rarity is kept in half powers of two of a counter, as the leading six bits of a ranked token.
LEVEL_BITS = 6
#: A token seen more often than this is split over salts, so that no group of one token grows beyond it.
GROUP_ROWS = 200_000
#: Classes whose sets are needed are marked in a bitmap of 2^22 bits; false marks only cost time.
MARK_BITS = 22
#: So many counters travel in one row.
PACK = 16
PACKED = "bucket int, " + ", ".join(f"n{i} long" for i in range(PACK))
CACHED_WORDS = 500_000
CHUNK_BYTES = 4 << 20
NO_ID = (1 << 63) - 1
#: Words are hashed block by block, so that running sums stay in the processor's cache.
BLOCK_BYTES = 1 << 17
BASE = 0xD6E8FEB86659FD93
MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class Sets(NamedTuple):
    """Records of some texts: where each comes from, its size, and all their distinct tokens one after the other."""

    text: np.ndarray
    number: np.ndarray
    size: np.ndarray
    tokens: np.ndarray

    @property
    def ends(self) -> np.ndarray:
        return np.cumsum(self.size)

    @property
    def record(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.size)), self.size)

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each set, whatever the order of its tokens."""
        ends = self.ends
        out = []
        for x in (mixed(self.tokens + MIX[0]), mixed(self.tokens * MIX[0] + np.uint64(1))):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)])
            out.append((sums[ends] - sums[ends - self.size]).astype(np.int64))
        return out[0], out[1]


#: Makes the sets of a list of texts; one is made for each task.
Splitter = Callable[[list[bytes]], Sets]


class WordHashes:
    """64-bit hashes of the words of a text, all at once.

    A word is a polynomial in an odd base over 2^64 of a number for each of its bytes; differences of running sums
    give it for every word of a block, and the inverse of the base shifts it to the word's own start.
    """

    def __init__(self) -> None:
        self.power = self.inverse = np.ones(0, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            for name, base in (("power", BASE), ("inverse", pow(BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def of(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of every word of `raw`."""
        data = np.frombuffer(raw, np.uint8)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~BLANK[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        cuts = np.append(np.searchsorted(starts, np.arange(0, len(data), BLOCK_BYTES)), len(starts)).tolist()
        found = np.zeros(len(starts), np.uint64)
        for i, j in itertools.pairwise(cuts):
            if i < j:
                first, last = starts[i], ends[j - 1]
                self._powers(int(last - first) + 1)
                sums = np.zeros(last - first + 1, np.uint64)
                np.cumsum(BYTES[data[first:last]] * self.power[: last - first], out=sums[1:])
                here = starts[i:j] - first
                found[i:j] = (sums[ends[i:j] - first] - sums[here]) * self.inverse[here]
        return starts, mixed(found)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\v\f\r", np.uint8))
BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * MIX[0])


def sort_each(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """`values` with every run of the given sizes sorted, in place."""
    end = 0
    for size in sizes.tolist():
        values[end : end + size].sort()
        end += size
    return values


def distinct(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, tokens) of records, each token once a record, sorted; tokens lie record by record. Changes `tokens`."""
    sort_each(tokens, sizes)
    new = np.ones(len(tokens), bool)
    new[1:] = tokens[1:] != tokens[:-1]
    starts = np.cumsum(sizes) - sizes
    new[starts[sizes > 0]] = True
    kept = np.concatenate([np.zeros(1, np.int64), np.cumsum(new)])
    return kept[starts + sizes] - kept[starts], tokens[new]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts) of some rows at a time, of about CHUNK_BYTES."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for one, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids.append(one)
            texts.append(text.as_py() or b"")
            size += len(texts[-1])
            if size >= CHUNK_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def _remembered(seen: dict, one: np.ndarray, two: np.ndarray, wanted: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which records of the wanted ones are new to this task, as far as it remembers, or come at an earlier place."""
    new = np.zeros(len(one), bool)
    at = np.flatnonzero(wanted)
    for i, a, b, here in zip(at.tolist(), one[at].tolist(), two[at].tolist(), place[at].tolist(), strict=True):
        if seen.get((a, b), here + 1) > here:
            if len(seen) >= CACHED_WORDS:
                seen.clear()
            seen[a, b] = here
            new[i] = True
    return new


def _ranker(table, bits: int) -> Callable[[np.ndarray], np.ndarray]:
    """Tokens as numbers in the global order, rare first."""

    def ranked(tokens: np.ndarray) -> np.ndarray:
        levels = table.value[0][(tokens >> np.uint64(64 - bits)).astype(np.int64)].astype(np.uint64)
        return (levels << np.uint64(63 - LEVEL_BITS)) | (tokens >> np.uint64(LEVEL_BITS + 1))

    return ranked


def counted_tokens(sets: Sets, bits: int) -> np.ndarray:
    """How many tokens of some sets each counter gets."""
    return np.bincount((sets.tokens >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)


def packed(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counters that aren't zero, PACK of them a row."""
    table = counts.reshape(-1, PACK)
    full = np.flatnonzero(table.any(axis=1))
    for i in range(0, len(full), 10_000):
        part = full[i : i + 10_000]
        yield pa.RecordBatch.from_pydict({"bucket": part.astype(np.int32)} | {f"n{k}": table[part, k] for k in range(PACK)})


def level(n: np.ndarray) -> np.ndarray:
    """Half powers of two."""
    return np.minimum(np.floor(2 * np.log2(np.maximum(n, 1))), (1 << LEVEL_BITS) - 1).astype(np.uint8)


def salts() -> np.ndarray:
    """Over how many salts the tokens of each level are split."""
    return np.maximum(1, 2 ** ((np.arange(1 << LEVEL_BITS) + 1) / 2) // GROUP_ROWS).astype(np.int64)


class SetJoin:
    """One similarity join over the records of a text column; similar: den * overlap >= num * union.

    bits: counts are kept by so many leading bits of a token's hash, whatever the corpus.
    """

    def __init__(self, df: DataFrame, id_col: str, text_col: str, splitter: Callable[[], Splitter], num: int, den: int, bits: int, scratch: Scratch):
        self.spark = df.sparkSession
        self.texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
        self.splitter, self.num, self.den, self.bits, self.scratch = splitter, num, den, bits, scratch
        self.table = self.spark.sparkContext.broadcast(self._table())
        self.ranked = _ranker(self.table, bits)

    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        """(level of each counter, salts of each level): 2^bits numbers and 64."""
        splitter, bits = self.splitter, self.bits

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            split, counts = splitter(), np.zeros(1 << bits, np.int64)
            for _, texts in _chunks(batches):
                counts += counted_tokens(split(texts), bits)
            yield from packed(counts)

        return self._levels(self.texts.mapInArrow(counted, PACKED))

    def _levels(self, counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """(level of each counter, salts of each level), of the packed counts of all tasks."""
        summed = counts.groupBy("bucket").agg(*(F.sum(f"n{i}").alias(f"n{i}") for i in range(PACK))).toArrow()  # at most 2^bits numbers
        n = np.zeros((1 << self.bits) // PACK * PACK, np.int64).reshape(-1, PACK)
        n[summed["bucket"].to_numpy()] = np.stack([summed[f"n{i}"].to_numpy() for i in range(PACK)], axis=1)
        return level(n.ravel()), salts()

    def rows(self) -> DataFrame:
        """(id, record, n, c1, c2) of every record; n is the size of its set."""
        splitter = self.splitter

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            split = splitter()
            for ids, texts in _chunks(batches):
                sets = split(texts)
                columns = pa.array(ids, pa.int64()).take(pa.array(sets.text)), sets.number.astype(np.int32), sets.size.astype(np.int32), *sets.digests()
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "record", "n", "c1", "c2"])

        return self.texts.mapInArrow(listed, "id long, record int, n int, c1 long, c2 long")

    def prefixes(self) -> DataFrame:
        """(token, salt, c1, c2, n, at): the prefix of every class, once or more.

        salt is 0 for tokens that need none. Within a task, a class is listed once while it is remembered.
        """
        splitter, ranked, table, num, den = self.splitter, self.ranked, self.table, self.num, self.den
        # A ranked token keeps all but the last bits of its hash, so its counter can be read from it.
        below, mask = np.uint64(63 - LEVEL_BITS - self.bits), np.uint64((1 << self.bits) - 1)

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            split, seen = splitter(), {}
            for _, texts in _chunks(batches):
                sets = split(texts)
                one, two = sets.digests()
                new = _remembered(seen, one, two, sets.size > 0, np.zeros(len(one), np.int64))
                tokens, n, one, two = sets.tokens[np.repeat(new, sets.size)], sets.size[new], one[new], two[new]
                record = np.repeat(np.arange(len(n)), n)
                value = sort_each(ranked(tokens), n)
                at = np.arange(len(value)) - np.repeat(np.cumsum(n) - n, n)
                keep = at < (n - -(-num * n // den) + 1)[record]
                record, value = record[keep], value[keep]
                salts = table.value[1][table.value[0][(value >> below & mask).astype(np.int64)]]
                salt = np.where(salts > 1, 1 + (one[record] & 0x7FFFFFFF) % salts, 0)
                columns = value.astype(np.int64), salt.astype(np.int32), one[record], two[record], n[record].astype(np.int32), at[keep].astype(np.int32)
                for i in range(0, len(record), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 100_000]) for c in columns], names=["token", "salt", "c1", "c2", "n", "at"])

        return self.texts.mapInArrow(listed, "token long, salt int, c1 long, c2 long, n int, at int")

    def sets(self, classes: DataFrame) -> DataFrame:
        """(c1, c2, set) of the classes of `classes` (c1, c2); set: the ranked tokens as big-endian bytes.

        Only the text at the first id of such a class is split into its set, besides texts without an id and falsely
        marked ones.
        """
        first = self.first_ids().join(classes.select("c1", "c2"), ["c1", "c2"], "left_semi")
        # bitmaps of 2^22 bits, whatever the corpus
        bits = self.spark.sparkContext.broadcast((
            self.marks(first.where("id is not null").select(F.col("id").bitwiseAND((1 << MARK_BITS) - 1))),
            self.marks(first.select(F.shiftrightunsigned("c1", 64 - MARK_BITS))),
        ))
        splitter, ranked = self.splitter, self.ranked

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            split, (by_id, by_class), seen = splitter(), (np.unpackbits(b).astype(bool) for b in bits.value), {}
            for ids, texts in _chunks(batches):
                wanted = [i is None or by_id[i & ((1 << MARK_BITS) - 1)] for i in ids]
                sets = split([t if w else b"" for t, w in zip(texts, wanted, strict=True)])
                one, two = sets.digests()
                here = (sets.size > 0) & by_class[(one.astype(np.uint64) >> np.uint64(64 - MARK_BITS)).astype(np.int64)]
                new = _remembered(seen, one, two, here, np.zeros(len(one), np.int64))
                ends = sets.ends
                raw = [np.sort(ranked(sets.tokens[ends[i] - sets.size[i] : ends[i]])).astype(">u8").tobytes() for i in np.flatnonzero(new)]
                yield pa.RecordBatch.from_arrays([pa.array(one[new]), pa.array(two[new]), pa.array(raw, pa.binary())], names=["c1", "c2", "set"])

        return self.texts.mapInArrow(listed, "c1 long, c2 long, set binary").dropDuplicates(["c1", "c2"])

    def first_ids(self) -> DataFrame:
        """(c1, c2, id): the smallest id of every class, null if none of its rows has one."""
        return self.rows().groupBy("c1", "c2").agg(F.min("id").alias("id"))

    @staticmethod
    def marks(numbers: DataFrame) -> np.ndarray:
        """A bitmap of the numbers below 2^MARK_BITS in the one column of a table."""
        marked = np.zeros(1 << MARK_BITS, bool)
        marked[numbers.toDF("m").select(F.col("m").cast("int")).distinct().toArrow()["m"].to_numpy()] = True
        return np.packbits(marked)

    def lengths_fit(self, a: Column, b: Column) -> Column:
        return (F.least(a, b) * self.den) >= (F.greatest(a, b) * self.num)

    def can_reach(self, a: Column, b: Column, shared: Column, at_a: Column, at_b: Column) -> Column:
        """Whether two sets can be similar that share `shared` tokens up to these places (positional filter)."""
        most = shared + F.least(a - at_a, b - at_b) - 1
        return most * (self.num + self.den) >= (a + b) * self.num

    def in_prefixes(self, a: Column, b: Column, at_a: Column, at_b: Column) -> Column:
        """Whether the token at these places can be the first that two similar sets of these sizes share.

        Prefixes are listed for the smallest partner that a set can have; for a given one they are shorter. The first shared
        token of a similar pair passes, and with a token all that the two share before it.
        """
        return self.can_reach(a, b, F.lit(1), at_a, at_b)

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The similar ones of (a1, a2, b1, b2), two distinct classes each.

        The sets to compare with one class `a` lie in lexicographic order, which is the depth-first order of their prefix
        tree: a set takes over the overlap of the path it shares with the one before, and a path whose remaining
        lengths can't reach the threshold is left, for all sets below it. Rows are streamed; classes with many
        partners are spread.
        """
        pairs = self.scratch.write(pairs)
        many = pairs.groupBy("a1", "a2").agg((F.count("*") / 500).cast("int").alias("parts"))
        none = F.lit(None).cast("long")
        heads = many.select("a1", "a2", F.explode(F.sequence(F.lit(0), "parts")).alias("part"), none.alias("b1"), none.alias("b2"))
        spread = pairs.join(many, ["a1", "a2"]).select("a1", "a2", F.pmod("b1", F.col("parts") + 1).cast("int").alias("part"), "b1", "b2")
        # Whose set goes where: each set is shuffled once to its class, and once for each place where it is compared.
        roles = self.scratch.write(heads.union(spread).withColumns({"c1": F.coalesce("b1", "a1"), "c2": F.coalesce("b2", "a2")}))
        placed = self.sets(roles).join(roles, ["c1", "c2"]).select("a1", "a2", "part", "b1", "b2", "set")
        num, den = self.num, self.den

        def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            head, tree = None, None
            for batch in batches:
                found: dict[str, list] = {k: [] for k in ("a1", "a2", "b1", "b2")}
                columns = [c.to_pylist() for c in batch.columns]
                for a1, a2, _, b1, b2, raw in zip(*columns, strict=True):
                    tokens = np.frombuffer(raw, ">u8").astype(np.uint64)
                    if b1 is None:
                        head, tree = (a1, a2), PrefixTree(tokens, num, den)
                    elif head == (a1, a2) and tree.similar(tokens):
                        for k, v in zip(found, (a1, a2, b1, b2), strict=True):
                            found[k].append(v)
                yield pa.RecordBatch.from_pydict(found, schema=pa.schema([(k, pa.int64()) for k in found]))

        ordered = placed.repartition("a1", "a2", "part").sortWithinPartitions("a1", "a2", "part", F.col("b1").isNotNull(), "set")
        return ordered.mapInArrow(walked, "a1 long, a2 long, b1 long, b2 long")


class PrefixTree:
    """Sets in lexicographic order against one set: a depth-first walk of their prefix tree.

    Of the path to the last set it keeps, for every depth, the overlap so far and how many tokens of the one set
    are behind; the next set goes on where its path leaves the last one.
    """

    BLOCK = 64

    def __init__(self, one: np.ndarray, num: int, den: int):
        self.one, self.num, self.den = one, num, den
        self.path, self.overlap, self.behind = one[:0], np.zeros(1, np.int64), np.zeros(1, np.int64)

    def similar(self, tokens: np.ndarray) -> bool:
        n, m = len(tokens), len(self.one)
        need = -(-self.num * (n + m) // (self.num + self.den))
        common = min(n, len(self.path))
        differ = np.flatnonzero(tokens[:common] != self.path[:common])
        depth = int(differ[0]) if len(differ) else common
        depth = min(depth, len(self.overlap) - 1)
        overlap, behind, at = self.overlap[: depth + 1], self.behind[: depth + 1], depth
        while True:
            if overlap[-1] + min(n - at, m - behind[-1]) < need or at == n:
                break
            part = tokens[at : at + self.BLOCK]
            left = np.searchsorted(self.one, part)
            hit = np.zeros(len(part), np.int64)
            inside = left < m
            hit[inside] = self.one[left[inside]] == part[inside]
            overlap = np.concatenate([overlap, overlap[-1] + np.cumsum(hit)])
            behind = np.concatenate([behind, left + hit])
            at += len(part)
        self.path, self.overlap, self.behind = tokens[:at], overlap, behind
        return at == n and bool(overlap[-1] >= need)
