"""N-gram Jaccard join: documents whose sets of 4-word shingles have a Jaccard similarity of 0.85 or more.

Sets are ordered globally, candidates share a token of their prefixes, and the candidates of a document are
compared with it along their prefix tree (see setjoin). Groups of near copies are joined through pivots and
contracted to components first, so that only pairs of different components are ever listed, and of those only
pairs whose sketches don't already show that they differ too much; no link between different components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eodlake.llm.common import cut, fresh, release, row_keys
from eodlake.llm.components import components
from eodlake.llm.setjoin import MIX, SetJoin, Sets, Splitter, WordHashes, _chunks, distinct, level, mixed, salts
from eodlake.session import Scratch, shuffles_removed

WORDS = 4
NUM, DEN = 85, 100
#: Rarity comes from 2^24 counters, one byte each where they are used; they are summed in slices of 2^16.
BITS, SLICE_BITS = 24, 16
#: How often each class meets another one, first a pivot, then near ones, before what is left open is joined.
ROUNDS = 3
#: Rows of a group that are held against each other; of a larger group, so many at a time.
BLOCK_ROWS = 500
BATCH_ROWS = 50_000
#: A set's sketch: for 512 bits the parity of how many of its tokens fall on them, as eight numbers.
SKETCH = [f"s{k}" for k in range(8)]
#: A class in the group of a token: with its component, how much it shares its tokens, and its sketch.
ROW = ["token", "salt", "c1", "c2", "n", "at", "r1", "r2", "central", *SKETCH]
#: What one pass over the texts writes: rows, and counters of slices.
READ = pa.schema([
    ("id", pa.int64()), ("n", pa.int32()), ("c1", pa.int64()), ("c2", pa.int64()), *((k, pa.int64()) for k in SKETCH), ("slice", pa.int32()), ("low", pa.binary()),
])


def shingles(words: int = WORDS) -> Splitter:
    """The set of shingles of each whole text; of all its words together if they are fewer, none without words."""
    hashes = WordHashes()

    def split(texts: list[bytes]) -> Sets:
        raw = b" ".join(texts).lower()  # of bytes: A-Z only, and ASCII blanks only
        starts, h = hashes.of(raw)
        texts_end = np.cumsum([len(t) + 1 for t in texts])
        n = np.diff(np.searchsorted(starts, texts_end), prepend=0)
        value = np.full(max(0, len(h) - words + 1), words, np.uint64)
        for k in range(words):
            value = mixed(value * MIX[0] + h[k : len(h) - words + 1 + k])
        ends = np.cumsum(n)
        inside = np.ones(len(value), bool)  # windows that don't go on into the next text
        for k in range(1, words):
            inside[(ends - k)[(ends >= k) & (ends - k < len(value))]] = False
        sizes, short = np.maximum(0, n - words + 1), np.flatnonzero((n > 0) & (n < words))
        value = value[inside]
        if len(short):
            whole = []
            for i in short.tolist():
                one = np.full(1, n[i], np.uint64)
                for x in h[ends[i] - n[i] : ends[i]]:
                    one = mixed(one * MIX[0] + x)
                whole.append(one[0])
            value = np.insert(value, np.cumsum(sizes)[short], np.array(whole, np.uint64))
            sizes[short] = 1
        sizes, tokens = distinct(value, sizes)
        return Sets(np.arange(len(n)), np.zeros(len(n), np.int64), sizes, tokens)

    return split


def sketches(sets: Sets) -> dict[str, np.ndarray]:
    """The sketch of each set. Two sketches differ in no more bits than their sets in tokens."""
    spot = mixed(sets.tokens + MIX[2]) >> np.uint64(55)
    bit, where = np.uint64(1) << (spot & np.uint64(63)), spot >> np.uint64(6)
    full = np.flatnonzero(sets.size)
    out = {}
    for k, name in enumerate(SKETCH):
        out[name] = np.zeros(len(sets.size), np.int64)
        if len(full):
            out[name][full] = np.bitwise_xor.reduceat(np.where(where == k, bit, np.uint64(0)), (sets.ends - sets.size)[full]).view(np.int64)
    return out


def _with_nulls(**columns) -> pa.RecordBatch:
    """Some columns of READ, the others null."""
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in READ], schema=READ)


class NgramJoin(SetJoin):
    """The join of whole texts. One pass lists the rows and counts their tokens."""

    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        splitter, bits = self.splitter, self.bits
        parts = 1 << (bits - SLICE_BITS)

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            split = splitter()
            for ids, texts in _chunks(batches):
                sets = split(texts)
                one, two = sets.digests()
                yield _with_nulls(id=pa.array(ids, pa.int64()), n=sets.size.astype(np.int32), c1=one, c2=two, **sketches(sets))
                counter = np.sort((sets.tokens >> np.uint64(64 - bits)).astype(np.uint32))
                ends = np.searchsorted(counter, np.arange(1, parts + 1) << SLICE_BITS)
                low = (counter & ((1 << SLICE_BITS) - 1)).astype("<u2")
                found = [low[i:j].tobytes() for i, j in zip([0, *ends[:-1]], ends, strict=True)]
                full = [k for k in range(parts) if found[k]]
                yield _with_nulls(slice=np.array(full, np.int32), low=pa.array([found[k] for k in full], pa.binary()))

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts: dict[int, np.ndarray] = {}  # 2^bits numbers at most
            for batch in batches:
                for k, low in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    n = counts.setdefault(k, np.zeros(1 << SLICE_BITS, np.int64))
                    n += np.bincount(np.frombuffer(low.as_py(), "<u2"), minlength=1 << SLICE_BITS)
            levels = [level(n).tobytes() for n in counts.values()]
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int32()), pa.array(levels, pa.binary())], names=["slice", "levels"])

        self.read = self.scratch.write(self.texts.mapInArrow(read, ", ".join(["id long, n int, c1 long, c2 long", *(f"{k} long" for k in SKETCH), "slice int, low binary"])))
        counters = self.read.where("slice is not null").select("slice", "low").repartition("slice")
        table = np.zeros(1 << bits, np.uint8).reshape(parts, -1)
        for row in counters.mapInArrow(summed, "slice int, levels binary").collect():  # 2^bits bytes at most
            table[row.slice] = np.frombuffer(row.levels, np.uint8)
        return table.ravel(), salts()

    def rows(self) -> DataFrame:
        """(id, n, c1, c2) of every row; n is the size of its set."""
        return self.read.where("slice is null").select("id", "n", "c1", "c2")

    def sketched(self) -> DataFrame:
        """The classes (c1, c2) with their sketches."""
        return self.read.where("n > 0").groupBy("c1", "c2").agg(*(F.min(k).alias(k) for k in SKETCH))

    def near(self, a: Column, b: Column, apart: Column) -> Column:
        """Whether sets of these sizes whose sketches differ in so many bits can be similar."""
        return apart * (self.num + self.den) <= (a + b) * (self.den - self.num)

    def first_ids(self) -> DataFrame:
        """(c1, c2, id) of every class with a shingle."""
        return self.classes


def _ends(df: DataFrame) -> DataFrame:
    return df.select(F.struct(F.col("a1").alias("c1"), F.col("a2").alias("c2")).alias("u"), F.struct(F.col("b1").alias("c1"), F.col("b2").alias("c2")).alias("v"))


def _apart(a: str, b: str) -> Column:
    """In how many bits two sketches, with these prefixes to their columns, differ."""
    return sum((F.bit_count(F.col(a + k).bitwiseXOR(F.col(b + k))) for k in SKETCH), F.lit(0))


def _rooted(rows: DataFrame, found: DataFrame) -> DataFrame:
    """`rows` with the components (r1, r2) of their classes (c1, c2) by the links found."""
    roots = components(found).select(F.col("node.c1").alias("c1"), F.col("node.c2").alias("c2"), F.col("root.c1").alias("r1"), F.col("root.c2").alias("r2"))
    return rows.drop("r1", "r2").join(roots, ["c1", "c2"], "left").withColumns({"r1": F.coalesce("r1", "c1"), "r2": F.coalesce("r2", "c2")})


def _open(rows: DataFrame, *group: str) -> DataFrame:
    """The groups that hold more than one component."""
    roots = F.struct("r1", "r2")
    return rows.groupBy(*group).agg(F.min(roots).alias("low"), F.max(roots).alias("high")).where("low != high").select(*group)


def _to_pivots(join: NgramJoin, rows: DataFrame) -> DataFrame:
    """(a1, a2, b1, b2): for each class b one pivot a of another component, the nearest by sketch.

    Each token group names one pivot, its most central class, so a group gives a row a member, and a class one pair.
    """
    own = {"c1": "a1", "c2": "a2", "n": "na", "at": "ata", "r1": "ra1", "r2": "ra2"} | {k: f"a_{k}" for k in SKETCH}
    best = F.max(F.struct("central", *(F.col(k).alias(v) for k, v in own.items()))).over(Window.partitionBy("token", "salt"))
    sizes = F.col("n"), F.col("na")
    other = (F.col("r1") != F.col("ra1")) | (F.col("r2") != F.col("ra2"))
    met = rows.withColumn("p", best).select(*rows.columns, *(f"p.{v}" for v in own.values()))
    met = met.where(other & join.lengths_fit(*sizes) & join.in_prefixes(*sizes, F.col("at"), F.col("ata")))
    met = met.withColumn("apart", _apart("", "a_")).where(join.near(*sizes, F.col("apart"))).withColumnsRenamed({"c1": "b1", "c2": "b2"})
    return met.groupBy("b1", "b2").agg(F.min(F.struct("apart", "a1", "a2")).alias("p")).select("p.a1", "p.a2", "b1", "b2")


def closest(rows: dict[str, np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, distance) of the two rows nearest to each by sketch, of other components of its group, that it may be similar to.

    Two columns each, -1 for none. Rows lie group by group; of every BLOCK_ROWS rows of a group, all meet.
    """
    size = len(rows["n"])
    new = np.ones(size, bool)
    new[1:] = (rows["token"][1:] != rows["token"][:-1]) | (rows["salt"][1:] != rows["salt"][:-1])
    starts = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    group = np.cumsum(new | ((np.arange(size) - starts[group]) % BLOCK_ROWS == 0))
    order = np.lexsort((rows["n"], group))
    group, n, r1, r2 = group[order], rows["n"][order], rows["r1"][order], rows["r2"][order]
    left, sketch = n - rows["at"][order], [rows[k][order].view(np.uint64) for k in SKETCH]
    by, far = np.full((size, 2), -1), np.full((size, 2), 1 << 30)
    i, step = np.arange(size), 1
    while len(i):
        # Of rows in order of n, each meets the one that many steps on, until that is too long or of another group.
        i = i[i + step < size]
        j = i + step
        fits = (group[i] == group[j]) & (n[i] * den >= n[j] * num)
        i, j = i[fits], j[fits]
        both = n[i] + n[j]
        hit = ((r1[i] != r1[j]) | (r2[i] != r2[j])) & (np.minimum(left[i], left[j]) * (num + den) >= both * num)
        a, b, both = i[hit], j[hit], both[hit]
        apart = np.zeros(len(a), np.int64)
        for s in sketch:
            apart += np.bitwise_count(s[a] ^ s[b])
        hit = apart * (num + den) <= both * (den - num)
        a, b, apart = a[hit], b[hit], apart[hit]
        for one, other in ((a, b), (b, a)):
            first = apart < far[one, 0]
            at, to, d = one[first], other[first], apart[first]
            by[at, 1], far[at, 1] = by[at, 0], far[at, 0]
            by[at, 0], far[at, 0] = to, d
            second = ~first & (apart < far[one, 1])
            by[one[second], 1], far[one[second], 1] = other[second], apart[second]
        step += 1
    found, apart = np.empty_like(by), np.empty_like(far)
    found[order], apart[order] = np.where(by >= 0, order[by], -1), far
    return found, apart


def _in_groups(rows: DataFrame, found: Callable[[dict[str, np.ndarray]], pa.RecordBatch], schema: str, *order: Column) -> DataFrame:
    """What `found` gives of the rows of whole groups (token, salt), of larger ones than BATCH_ROWS in pieces."""
    columns = ROW

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = dict.fromkeys(columns, np.zeros(0, np.int64))
        for batch in batches:
            held = {k: np.concatenate([v, batch.column(k).to_numpy().astype(np.int64)]) for k, v in held.items()}
            if len(held["n"]) >= BATCH_ROWS:
                last = np.flatnonzero((held["token"] != held["token"][-1]) | (held["salt"] != held["salt"][-1]))
                end = int(last[-1]) + 1 if len(last) else len(held["n"])
                yield found({k: v[:end] for k, v in held.items()})
                held = {k: v[end:] for k, v in held.items()}
        if len(held["n"]):
            yield found(held)

    return rows.select(*columns).repartition("token", "salt").sortWithinPartitions("token", "salt", *order).mapInArrow(each, schema)


def _with_partners(join: NgramJoin, rows: DataFrame) -> DataFrame:
    """`rows` without those that no other of their token can be similar to: common words alone link nothing.

    Of a similar pair, the rows of every token that counts for it stay. Tokens that many share, or that are split over salts, stay as they are.
    """
    num, den = join.num, join.den
    small = (F.col("many") <= BLOCK_ROWS) & (F.col("salt") == 0)

    def partnered(x: dict[str, np.ndarray]) -> pa.RecordBatch:
        keep = closest(x, num, den)[0][:, 0] >= 0
        return pa.RecordBatch.from_pydict({k: x[k][keep] for k in ROW})

    kept = _in_groups(rows.where(small), partnered, ", ".join(f"{k} long" for k in ROW))
    return rows.where(~small).select(*(F.col(k).cast("long") for k in ROW)).union(kept)


def _of_fitting_length(join: NgramJoin, rows: DataFrame) -> DataFrame:
    """`rows` (one a class and token) without those whose token no other of a fitting size has; tokens split over salts stay.

    Of all sizes, the next ones below and above fit best. Larger partners must also leave enough behind the token.
    """
    by_size = Window.partitionBy("token", "salt").orderBy("n")
    n, below, above = F.col("n"), F.lag("n").over(by_size), F.lead("n").over(by_size)
    sized = rows.withColumns({"below": below, "above": above})
    smaller = F.col("below").isNotNull() & join.lengths_fit(n, F.col("below"))
    larger = F.col("above").isNotNull() & join.lengths_fit(n, F.col("above")) & join.in_prefixes(n, F.col("above"), F.col("at"), F.lit(0))
    return sized.where((F.col("salt") > 0) | smaller | larger).drop("below", "above")


def _canonical(pairs: DataFrame) -> DataFrame:
    """Distinct pairs, the smaller class first."""
    a, b = F.struct(F.col("a1").alias("c1"), F.col("a2").alias("c2")), F.struct(F.col("b1").alias("c1"), F.col("b2").alias("c2"))
    return pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).selectExpr("a.c1 AS a1", "a.c2 AS a2", "b.c1 AS b1", "b.c2 AS b2").distinct()


def _to_nearest(join: NgramJoin, rows: DataFrame, tried: DataFrame, turn: int) -> DataFrame:
    """(a1, a2, b1, b2): for each class the nearest by sketch, of another component, that it hasn't met.

    A token group names two for each row, of a block that changes every turn.
    """
    num, den = join.num, join.den

    def near(x: dict[str, np.ndarray]) -> pa.RecordBatch:
        found, apart = closest(x, num, den)
        own, k = np.nonzero(found >= 0)
        to = found[own, k]
        return pa.RecordBatch.from_pydict({"a1": x["c1"][to], "a2": x["c2"][to], "b1": x["c1"][own], "b2": x["c2"][own], "apart": apart[own, k]})

    # few groups are open after pivots, while most have several classes before
    rows = rows.join(_open(rows, "token", "salt"), ["token", "salt"], "left_semi")
    named = _in_groups(rows, near, "a1 long, a2 long, b1 long, b2 long, apart long", F.xxhash64(F.lit(turn), "c1"))
    known = tried.union(tried.select("b1", "b2", "a1", "a2").toDF(*tried.columns))
    named = named.join(known, ["a1", "a2", "b1", "b2"], "left_anti")
    return _canonical(named.groupBy("b1", "b2").agg(F.min(F.struct("apart", "a1", "a2")).alias("p")).select("p.a1", "p.a2", "b1", "b2"))


def _left_open(join: NgramJoin, rows: DataFrame) -> DataFrame:
    """(a1, a2, b1, b2): all pairs of different components that may be similar."""
    rest = rows.join(_open(rows, "token"), "token", "left_semi").select("token", "c1", "c2", "n", "at", "r1", "r2", *SKETCH)
    a = rest.toDF("token", "a1", "a2", "na", "ata", "ra1", "ra2", *(f"a_{k}" for k in SKETCH))
    b = rest.toDF("token", "b1", "b2", "nb", "atb", "rb1", "rb2", *(f"b_{k}" for k in SKETCH))
    # of two sets, the smaller one is a; of equal size, the one with the smaller digest
    ordered = (F.col("na") < F.col("nb")) | (F.col("na") == F.col("nb")) & (F.struct("a1", "a2") < F.struct("b1", "b2"))
    other = (F.col("ra1") != F.col("rb1")) | (F.col("ra2") != F.col("rb2"))
    sizes = F.col("na"), F.col("nb")
    places = F.col("ata"), F.col("atb")
    fit = join.lengths_fit(*sizes) & join.in_prefixes(*sizes, *places) & join.near(*sizes, _apart("a_", "b_"))
    return (
        a.join(b, (a["token"] == b["token"]) & ordered & other & fit)
        .groupBy("a1", "a2", "b1", "b2", "na", "nb")
        .agg(F.count("*").alias("shared"), F.max("ata").alias("ata"), F.max("atb").alias("atb"))
        .where(join.can_reach(*sizes, F.col("shared"), *places))
        .select("a1", "a2", "b1", "b2")
    )


def _links(join: NgramJoin, scratch: Scratch) -> DataFrame:
    """(u, v) of structs (c1, c2): links whose components are those of all links.

    ROUNDS times, each class meets another one, and what is linked is contracted: first a pivot, which links a whole group around
    it, then the nearest one of another component, which links groups that have no middle. Then all pairs of components that are
    left are compared, which those rounds make few: so no link between components is lost.
    """
    own = Window.partitionBy("token", "salt")
    # Groups are of GROUP_ROWS at most in the mean of what shares a counter: a hot token has many salts.
    rows = (
        join.prefixes()
        .withColumns({"low": F.min("c1").over(own), "high": F.max("c1").over(own), "many": F.count("*").over(own)})
        .where((F.col("low") < F.col("high")) | (F.col("salt") > 0))
        .dropDuplicates(["token", "salt", "c1", "c2"])
        .drop("low", "high")
    )
    rows = scratch.write(_of_fitting_length(join, rows))
    # Central is a class whose tokens are shared most: copies lie around their original.
    central = (1e6 * F.avg(F.log("many")).over(Window.partitionBy("c1", "c2"))).cast("long")
    own_root = {"r1": F.col("c1"), "r2": F.col("c2")}
    rows = scratch.write(rows.withColumn("central", central).join(join.sketched(), ["c1", "c2"]).withColumns(own_root), rows)
    rows = scratch.write(_with_partners(join, rows), rows)
    release(join.spark)
    found = tried = None
    for turn in range(ROUNDS):
        pairs = scratch.write(_to_nearest(join, rows, tried, turn) if turn else _to_pivots(join, rows))
        tried = pairs if tried is None else tried.union(pairs)
        links = scratch.write(_ends(join.verified(pairs)))
        found = links if found is None else found.union(links)
        rows = scratch.write(_rooted(rows, found), rows)
        release(join.spark)
    return found.union(_ends(join.verified(_left_open(join, rows))))


def join_ngrams(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """(id, n_shingles, component_id) of every row of `df`, repeated rows included.

    component_id is the smallest id that links reach, the row's own included. Null and empty texts have no
    shingles and no links; rows without an id take part, and have a null component_id only if nothing they are
    linked with has an id. An empty table gives no rows. Further columns are not read.
    """
    with Scratch(df.sparkSession, lean=True) as scratch, shuffles_removed(df.sparkSession):
        join = NgramJoin(df, id_col, text_col, lambda: shingles(words), num, den, BITS, scratch)
        rows = join.rows()
        join.classes = scratch.write(rows.where("n > 0").groupBy("c1", "c2").agg(F.min("id").alias("id")))
        roots = components(_links(join, scratch))
        joined = join.classes.join(roots.select(F.col("node.c1").alias("c1"), F.col("node.c2").alias("c2"), "root"), ["c1", "c2"], "left")
        joined = joined.withColumn("root", F.coalesce("root", F.struct("c1", "c2")))
        whole = joined.groupBy("root").agg(F.min("id").alias("component_id"))
        named = joined.join(whole, "root").select("c1", "c2", "component_id")
        return cut(
            rows.join(named, ["c1", "c2"], "left").select(
                "id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
            )
        )


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """The rows of `df`, all columns, whose id is the smallest of what links reach; rows without shingles all stay.

    Rows without an id always stay. Rows that repeat an id are judged by their own text; of equal rows all stay or all go.
    """
    key, gone_key = fresh(df, "row_key"), fresh(df, "gone_key")
    numbered = row_keys(df, id_col, text_col, key)
    gone = join_ngrams(numbered, key, text_col, words, num, den).where("id != component_id").select(F.col("id").alias(gone_key)).distinct()
    gone_too = (F.col(key) == F.col(gone_key)) & F.col(id_col).isNotNull()
    return numbered.join(gone, gone_too, "left_anti").select(*df.columns)
