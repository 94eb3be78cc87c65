"""Spelling variants: words that one inserted, deleted or replaced letter turns into each other.

Two words at one edit share their first half or their last half, as the edit lies in one of them; a half is half the length
of the shorter word. So words are dealt by (length of the shorter, side, half), each to at most four places: once as
the shorter and once as the longer one, for both sides. At a place the words get a bit-sliced index: for each position and
letter a bitset over the words. `near` runs a query along it, all words at a step: one bitset holds the words that
agree so far, three more those with one error behind them, a replaced letter (same position), a letter more (next
position) or a letter less (position before). A word found over its last half is left out if its first half agrees too,
so each pair counts once on each side. Only counts and the best form leave a task, never the pairs.

A place with more words than a slice holds is cut into slices, each an index of its own, and every word of the place
asks each slice; (slice, block of queries) are rows of their own, so a large place is spread over tasks.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eodlake.llm.common import cut

MIN_LENGTH, MIN_COUNT = 6, 5
#: A form is so many times as frequent as its variant.
RATIO = 5
#: Words of a slice of the index, and of a block of queries.
SLICE = 1 << 13
#: Distinct words that a task holds before it passes them on.
HELD = 1 << 18

# The letters of a run, as Latin-1 bytes; A-Z become lower case, all else a blank.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def _count(harm: int, shortest: int):
    """(word, n) of whole texts, summed as far as a task can hold them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            out = pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                # letters are Latin-1; anything beyond ends a run, as "?" does
                runs = Counter(text.encode("latin-1", "replace").translate(_LETTERS).split(b" "))
                for run, n in runs.items():
                    if len(run) < shortest:
                        continue
                    if harm:
                        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
                        if h % harm == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < shortest:
                                continue
                    held[run] += n
            if len(held) > HELD:
                yield flush()
        if held:
            yield flush()

    return count


def word_counts(
    docs: DataFrame, id_: str = "doc_id", text: str = "text", harm: int = 0, shortest: int = MIN_LENGTH, least: int = MIN_COUNT
) -> DataFrame:
    """(word, n) of the maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case, of at least `shortest` letters.

    With `harm`, a run whose crc32 of `<id>:<run>` it divides loses the letter at that number modulo its length. A
    null text has no runs; a null id counts as empty text. Rows count as often as they stand in the table.
    """
    texts = docs.select(id_, text).where(F.col(text).isNotNull())
    found = texts.mapInArrow(_count(harm, shortest), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class Index:
    """Bitsets over words for each (position, letter): whole numbers, whose operators take many words at a step."""

    def __init__(self, words: list[str]):
        self.words = words
        self._bits: dict[tuple[int, str], int] = {}
        self._of_length: dict[int, int] = {}
        for i, word in enumerate(words):
            bit = 1 << i
            self._of_length[len(word)] = self._of_length.get(len(word), 0) | bit
            for key in enumerate(word):
                self._bits[key] = self._bits.get(key, 0) | bit

    def near(self, word: str, agree: int = 0) -> list[int]:
        """Numbers of the words one edit from `word`; with `agree`, without those that share so many first letters."""
        same = (1 << len(self.words)) - 1  # agree so far
        other = more = less = shared = 0  # one error behind: another letter, one more, one less than here
        bits = self._bits.get
        for i, letter in enumerate(word):
            here = bits((i, letter), 0)
            more = (more | same) & bits((i + 1, letter), 0)  # theirs stands before this one, or did
            less = less & bits((i - 1, letter), 0) | same
            other = other & here | same & ~here
            same &= here
            if i + 1 == agree:
                shared = same
            if not (same | other | more | less):
                return []
        n, long = len(word), self._of_length.get
        found = other & long(n, 0) | (more | same) & long(n + 1, 0) | less & long(n - 1, 0)
        found &= ~shared
        out = []
        while found:
            low = found & -found
            out.append(low.bit_length() - 1)
            found ^= low
        return out


_FOUND = {"word": pa.string(), "n_near": pa.int64(), "form": pa.string(), "form_n": pa.int64()}


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per (length of the shorter, side, words of a slice, a block of queries): n_near and best form of each query."""
    for batch in batches:
        out = []
        for shorter, side, words, block in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            index = Index([w["word"] for w in words])
            counts = [w["n"] for w in words]
            for query in block:
                word = query["word"]
                met = index.near(word, shorter // 2 if side else 0)
                # a pair belongs where the shorter of both has the length of the place
                met = [i for i in met if min(len(index.words[i]), len(word)) == shorter]
                if met:
                    count, form = min((-counts[i], index.words[i]) for i in met)
                    out.append((word, len(met), form, -count))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), _FOUND.values(), strict=True)], names=list(_FOUND))


def near_words(words: DataFrame, slice_: int = SLICE) -> DataFrame:
    """(word, n_near, form, form_n) of the words with near ones; form is the near word of largest n, the least of equals."""
    length = F.length("word")
    place = ["shorter", "side", "half"]
    places = (
        words.select("word", "n", F.explode(F.array(length, length - 1)).alias("shorter"))
        .withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("half", F.expr("if(side = 0, left(word, shorter div 2), right(word, shorter div 2))"))
    )
    # the words of a place fall into parts by their hash; a place within a slice has one
    sizes = places.groupBy(*place).agg(F.count("*").alias("size")).where("size > 1")
    dealt = cut(
        places.join(sizes, place)
        .withColumn("parts", F.ceil(F.col("size") / slice_).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
        .groupBy(*place, "parts", "part")
        .agg(F.array_sort(F.collect_list(F.struct("word", "n"))).alias("words"))
    )
    # every part asks every part of its place
    asked = dealt.select(*place, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("words").alias("block"))
    rows = dealt.select(*place, "part", "words").join(asked, [*place, "part"]).select("shorter", "side", "words", "block")
    # the rows are small and their work is not: adaptive execution would put them into few tasks
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = rows.repartition(tasks).mapInArrow(_search, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("k"), "form")).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.k")).alias("form_n"))


def group_variants(words: DataFrame, slice_: int = SLICE, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of (word, n) rows with distinct words; a word alone is its own root.

    A form counts if its n is at least `ratio` times the word's. Each step to a form multiplies n by `ratio`, so there are few
    steps and no circles; they are followed by doubling. Order is by code points. An empty table gives no rows.
    """
    words = cut(words.select("word", "n"))
    found = words.join(near_words(words, slice_), "word", "left")
    counts = F.col("form_n") >= ratio * F.col("n")
    formed = cut(found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(counts, F.col("form")).alias("form"), F.when(counts, F.col("form_n")).alias("form_n"),
    ))
    steps = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = cut(steps.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")))
        steps = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            break
    return formed.join(steps, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
