"""Benchmark decontamination by template windows, with DataFrame functions only.

Texts are brought to templates: numbers, names and units become typed placeholders, and case and outer
punctuation go. Windows of five template words are hash-joined with those of the benchmark. Matched windows
of one alignment (document position less item position) must fill each slot value of the item by one
value of the document, the one it has most often: a question asked again with other numbers passes, rows of unrelated
numbers don't, and one changed number of a repeated value leaves out only the windows that hold it.
A document is contaminated by an item when half of the item's windows are found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eodlake.llm.common import cut

WINDOW = 5
SHARE = 0.5
#: Benchmarks of up to so many windows are sent to every task (16 MB); larger ones are joined by shuffle.
BROADCAST_WINDOWS = 200_000

#: Fixed word list: units that follow a number or stick to it.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb oz ml l s sec min h hr hrs hours minutes seconds days weeks months years "
    "metres meters kilometres kilometers miles feet inches grams kilograms litres liters dollars euros cents usd eur"
)
_UNIT = "(?:" + "|".join(UNITS.split()) + ")"
_END = r"(?=[\x20\x09-\x0D]|$)"
_NUMBER = r"[+\-$€£]?[0-9][0-9.,:/]*(?:st|nd|rd|th)?%?"
#: (pattern, placeholder), in turn. Each keeps the number of words, so template and text stay aligned.
_TYPED = (
    (r"(?<=[\p{L}\p{N},;)][\x20\x09])\p{Lu}\p{Ll}+(?:['’]s)?(?=\p{Punct}*(?:[\x20\x09-\x0D]|$))", "⟨name⟩"),
    (rf"(?i)(?<![^\x20\x09-\x0D(]){_NUMBER}{_UNIT}(?=\p{{Punct}}*{_END})", "⟨quantity⟩"),
    (rf"(?<![^\x20\x09-\x0D(]){_NUMBER}(?=\p{{Punct}}*{_END})", "⟨number⟩"),
    (rf"(?i)(?<=⟨number⟩[\x20\x09]){_UNIT}(?=\p{{Punct}}*{_END})", "⟨unit⟩"),
    (rf"(?<=[\p{{L}}\p{{N}}⟩])\p{{Punct}}+{_END}", ""),
    (r"(?<![^\x20\x09-\x0D])\p{Punct}+(?=[\p{L}\p{N}⟨])", ""),
)
#: Outer punctuation of slot values; signs, currencies and per cents belong to the value.
_OUTER = rf"(?<=[\p{{L}}\p{{N}}%])[\p{{Punct}}&&[^%]]+{_END}|(?<![^\x20\x09-\x0D])[\p{{Punct}}&&[^+\-$]]+(?=[\p{{L}}\p{{N}}+\-$€£])"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def template(text: Column) -> Column:
    """The text with placeholders, in lower case, without outer punctuation; as many words as before."""
    for pattern, placeholder in _TYPED:
        text = F.regexp_replace(text, F.lit(pattern), F.lit(placeholder))
    return F.lower(text)


def _split(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, w, raw_w): template words, and the text's own ones without outer punctuation; the latter null if no word is typed."""
    typed = df.select(*keys, F.col(text).alias("raw"), template(F.col(text)).alias("canonical"))
    own = _words(F.lower(F.regexp_replace("raw", F.lit(_OUTER), F.lit(""))))
    return typed.select(*keys, _words(F.col("canonical")).alias("w"), F.when(F.contains("canonical", F.lit("⟨")), own).alias("raw_w"))


def _hashes(k: int, literal: int) -> Column:
    """The hash of each window of k words, in order. With fewer than `literal` literal words it takes the values themselves."""

    def one(i: Column) -> Column:
        part = F.slice("w", i, k)
        of_words = F.xxhash64(F.lit(k), part)
        typed = F.size(F.filter(part, lambda x: F.startswith(x, F.lit("⟨"))))
        plain = F.xxhash64(F.lit(-k), F.slice("raw_w", i, k))
        return F.when(F.col("raw_w").isNotNull() & (F.lit(k) - typed < literal), plain).otherwise(of_words)

    found = F.when(F.size("w") >= k, F.transform(F.sequence(F.lit(1), F.size("w") - (k - 1)), one))
    return F.coalesce(found, F.array().cast("array<bigint>"))


def _slots(k: int) -> Column:
    """The text's words at the placeholders of each window, in order."""

    def one(i: Column) -> Column:
        marks = F.transform(F.slice("w", i, k), lambda x: F.startswith(x, F.lit("⟨")))
        return F.filter(F.slice("raw_w", i, k), lambda _, j: F.get(marks, j))

    none = F.array().cast("array<string>")
    return F.when(F.size("w") >= k, F.transform(F.sequence(F.lit(1), F.size("w") - (k - 1)), lambda i: F.when(F.col("raw_w").isNotNull(), one(i)).otherwise(none)))


def windows(df: DataFrame, keys: list[str], text: str, lengths: list[int]) -> DataFrame:
    """(keys, position, hash, slots) of each window.

    slots: the text's words at the window's placeholders, in lower case and without outer punctuation, in order. Windows shorter than
    WINDOW have as many words as the item that they stand for. A window with fewer than two literal words (one, if items
    are shorter) is told by its values too: it meets only windows that hold the same.
    """
    split, literal = _split(df, keys, text), min(2, min(lengths))
    out = None
    for k in lengths:
        pairs = F.arrays_zip(_hashes(k, literal).alias("hash"), F.coalesce(_slots(k), F.array().cast("array<array<string>>")).alias("slots"))
        rows = split.select(*keys, F.posexplode(pairs).alias("at", "x")).select(*keys, (F.col("at") + 1).alias("position"), "x.hash", "x.slots")
        out = rows if out is None else out.union(rows)
    return out


def _agreed(pairs: Column) -> Column:
    """Of the (asked, found) pairs of an alignment, those that count: equal ones, and for each asked value the pair seen most often."""
    distinct = F.array_distinct(pairs)

    def most(p: Column) -> Column:
        rivals = F.filter(distinct, lambda q: q["asked"] == p["asked"])
        times = lambda q: F.size(F.filter(pairs, lambda r: r == q))
        best = F.array_max(F.transform(rivals, lambda q: F.struct(times(q).alias("n"), (q["asked"] == q["found"]).alias("same"), q["found"].alias("found"))))
        return (p["asked"] == p["found"]) | (best["found"] == p["found"])

    return F.filter(distinct, most)


def leaks(
    documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", share: float = SHARE,
) -> DataFrame:
    """(doc_key, item, item_windows, found_windows, other_values) of each document with `share` of an item.

    doc_key is (id, hash of the text), so rows without an id and ids given twice are judged on their own;
    rows alike in both count as one. other_values: slot values that differ from the item's. Null and empty texts
    have no windows. Items of fewer than five words are looked for as a whole; items without words never
    match, items of nothing but numbers only by the same numbers. Neither side's further columns are read. Empty tables
    give no rows.

    A first pass over the documents makes hashes alone and keeps those that meet a window; slots are read of these.
    """
    items = benchmark.select(F.col(item_id).alias("item"), F.col(item_text).alias("text"))
    length = F.least(F.size(_words(F.col("text"))), F.lit(WINDOW))
    lengths = sorted(r[0] for r in items.dropna().select(length).distinct().collect() if r[0] > 0)
    lengths = lengths or [WINDOW]
    wanted = None
    for k in lengths:
        own = windows(items.dropna().where(length == k), ["item"], "text", [k])
        wanted = own if wanted is None else wanted.union(own)
    wanted = wanted.toDF("item", "item_position", "hash", "item_slots")
    totals = wanted.groupBy("item").agg(F.count("*").alias("item_windows"))
    hashes = wanted.select("hash").distinct()
    if wanted.count() <= BROADCAST_WINDOWS:
        wanted, totals, hashes = F.broadcast(wanted), F.broadcast(totals), F.broadcast(hashes)
    key = F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("text_hash"))
    texts = documents.select(key.alias("doc_key"), F.col(text).alias("text"))
    all_hashes = F.flatten(F.array(*[_hashes(k, min(2, min(lengths))) for k in lengths]))
    met = _split(texts, ["doc_key"], "text").select("doc_key", F.explode(all_hashes).alias("hash")).join(hashes, "hash", "left_semi")
    # rows alike in id and text are told once
    met = cut(texts.dropDuplicates(["doc_key"]).join(met.select("doc_key").distinct(), "doc_key", "left_semi"))
    pair = lambda a, b: F.struct(a.alias("asked"), b.alias("found"))
    found = windows(met, ["doc_key"], "text", lengths).join(wanted, "hash").select(
        "doc_key", "item", "item_position", (F.col("position") - F.col("item_position")).alias("shift"),
        F.zip_with("item_slots", "slots", pair).alias("pairs"),
    )
    # an alignment has one window a position of the item, so its size is bounded by the item
    aligned = found.groupBy("doc_key", "item", "shift").agg(F.collect_list(F.struct("item_position", "pairs")).alias("met"))
    aligned = aligned.withColumn("agreed", _agreed(F.flatten(F.transform("met", lambda m: m["pairs"]))))
    kept = aligned.select(
        "doc_key", "item", F.explode(F.filter("met", lambda m: F.forall(m["pairs"], lambda p: F.array_contains(F.col("agreed"), p)))).alias("m"), "agreed"
    )
    return (
        kept.groupBy("doc_key", "item")
        .agg(
            F.size(F.collect_set("m.item_position")).cast("long").alias("found_windows"),
            F.max(F.size(F.filter("agreed", lambda p: p["asked"] != p["found"]))).cast("long").alias("other_values"),
        )
        .join(totals, "item")
        .where(F.col("found_windows") >= F.lit(share) * F.col("item_windows"))
        .select("doc_key", "item", "item_windows", "found_windows", "other_values")
    )


def clean(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `documents`, all columns, that no item contaminates."""
    bad = leaks(documents, benchmark, doc_id, text).select(F.col("doc_key.id").alias("bad_id"), F.col("doc_key.text_hash").alias("bad_hash")).distinct()
    same = documents[doc_id].eqNullSafe(F.col("bad_id")) & (F.xxhash64(documents[text]) == F.col("bad_hash"))
    return documents.join(bad, same, "left_anti")
