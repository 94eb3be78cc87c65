"""Suffix dedup, conversation repair and spelling variants: against brute force, and with nulls, ties, repeated rows,
empty tables, very long texts and other columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from eodlake.llm import conversations, spelling, suffix_dedup
from eodlake.llm.queries import QUERIES
from eodlake.llm.suffix_array import common_prefixes, small_kind, suffix_order

SF = "/root/testdata/sf0.001"
MORE = "a string, e string, text_ string, part string, spans string, start string, fault string, key string, Word string, n string, side string"


def wide(spark, rows, schema):
    """The rows with further columns that clash with names inside the operators."""
    extra = tuple("x" for _ in MORE.split(","))
    return spark.createDataFrame([(*r, *extra) for r in rows], f"{schema}, {MORE}")


def folder(spark, tmp_path, **tables):
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


# ---- suffix dedup ----


@pytest.mark.parametrize("letters", [1, 2, 4, 256])
def test_suffix_order(letters):
    r = np.random.default_rng(letters)
    for n in (1, 2, 3, 9, 17, 100, 500):
        text = r.integers(0, letters, n).astype(np.uint8)
        order, whole = suffix_order(text, n), text.tobytes()
        assert list(order) == sorted(range(n), key=lambda i: whole[i:])
        assert list(small_kind(text)) == [whole[i:] < whole[i + 1 :] for i in range(n)]
        for i, c in enumerate(common_prefixes(text, order, 50)):
            a, b = (whole[order[i - 1] :], whole[order[i] :]) if i else (b"", b"")
            assert c == min(50, next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))))
    assert len(suffix_order(np.zeros(0, np.uint8), 50)) == 0


def removed_by_hand(rows, length=50):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1 if d is not None else 0):
            first[b[i : i + length]] = min(first.get(b[i : i + length], d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1 if d is not None else 0):
            if first[b[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def patched(seed, n=120):
    """Texts from shared pieces, cut anywhere."""
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randint(20, 400))) for _ in range(12)]
    new = lambda: "".join(rnd.choice("xyzw") for _ in range(rnd.randint(0, 80)))
    old = lambda: rnd.choice(pool)[rnd.randint(0, 60) : rnd.randint(60, 400)]
    return [(d, "".join(old() if rnd.random() < 0.7 else new() for _ in range(rnd.randint(0, 8)))) for d in range(n)]


#: Repeated ids with equal and with other texts, nulls, periods, texts of exactly and almost the length.
ODD = [
    (7, "p" * 60 + "q" * 60), (7, "q" * 60 + "r" * 60), (7, "q" * 60 + "r" * 60), (None, "q" * 300), (None, None), (200, None), (201, "a" * 3000),
    (202, "a" * 2000), (5, "a" * 100), (203, "ab" * 800), (204, "xab" * 1000), (205, "ab" * 300), (206, "a" * 50), (207, "a" * 49), (208, ""), (-3, "ab" * 30),
]


@pytest.mark.parametrize("block", [400, 1 << 21])
def test_repeats_equal_brute_force(spark, block):
    rows = patched(block) + ODD
    df = wide(spark, rows, "doc_id long, text string").repartition(3)
    left = suffix_dedup.remove_repeats(df, block=block).selectExpr("doc", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256)")
    assert sorted([tuple(r) for r in left.collect()], key=str) == removed_by_hand(rows)


def test_long_texts_come_in_pieces(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 300)
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("ab") for _ in range(n)).encode() for n in (1000, 10, 0, 299, 301, 2500)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(6), pa.int64()), pa.array([0] * 6, pa.int64()), pa.array(texts, pa.binary())], names=["doc", "part", "text"]
    )
    covered = defaultdict(set)
    for out in suffix_dedup._anchors(50)(iter([batch])):
        for row in out.to_pylist():
            start, long = row["place"] >> 32, row["place"] & 0xFFFFFFFF
            assert long >= 50
            covered[row["doc"]].update(range(start, start + long - 49))
    assert {d: len(s) for d, s in covered.items()} == {d: len(t) - 49 for d, t in enumerate(texts) if len(t) >= 50}


def test_op11_query(spark, tmp_path):
    rows = patched(8, 60) + [(300, "long " * 40_000), (301, "so long " * 9_000 + "long " * 20)]
    sf = folder(spark, tmp_path, documents=wide(spark, rows, "doc_id long, text string"))
    found = QUERIES["op11_suffix_dedup"](spark, sf)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted([tuple(r) for r in found.collect()], key=str) == removed_by_hand(rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(empty).collect() == []


# ---- conversations ----


def cheapest(rows):
    """(cost, letters) by working back from the end; rows are (role, fault)."""
    states = range(4)
    after = {q: (0, "") if q in (0, 3) else None for q in states}
    add = lambda cost, letter, rest: None if rest is None else (cost + rest[0], letter + rest[1])
    best = lambda *options: min((o for o in options if o), default=None)
    given = {0: 2, 1: 2, 2: 3, 3: 2}
    kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def with_inserts(now):
        for _ in range(6):
            now = {q: best(now[q], add(3, "I", now[given[q]])) for q in states}
        return now

    after = with_inserts(after)
    for role, fault in reversed(rows):
        now = {}
        for q in states:
            options = [add(4, "D", after[q])]
            if fault not in (1, 2):
                extra = 3 if fault == 3 else 0
                options += [add(3 + extra, "R", after[given[q]]), add(extra, "K", after[kept[q, role[:1]]]) if (q, role[:1]) in kept else None]
            now[q] = best(*options)
        after = with_inserts(now)
    return after[0]


@pytest.mark.parametrize("whole, piece", [(64, 8), (3, 2), (1, 1), (6, 3)])
def test_search_finds_the_cheapest_and_least(whole, piece):
    for seed in range(400):
        rnd = random.Random(seed)
        rows = [(rnd.choice(["system", "user", "assistant", "tool", "user", ""]), rnd.choice([0, 0, 0, 1, 2, 3])) for _ in range(rnd.randint(0, 25))]
        repair = conversations.Repair(whole, piece)
        for role, fault in rows:
            repair.row(role, "t", (role[:1] if role[:1] in tuple("sua") else "?") + "-xxt"[fault])
        assert repair.done()[:2] == cheapest(rows), rows


def reported(rows):
    """The contract of op12 by hand."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        groups[conv] += [(turn, "user" if h == 4 else role, text)] * {0: 0, 3: 2}.get(h, 1)
    out = []
    for conv, turns in groups.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, marked, counts = set(), [], [0, 0, 0, 0]
        for _, role, text in turns:
            visible = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 1 if not visible else 2 if (role, text) in seen else 0 if visible[-1] in ".!?" else 3
            seen.add((role, text))
            counts[fault] += 1
            marked.append((role, fault))
        known = sorted({t for t, _, _ in turns if t is not None})
        initials = [r[:1] for _, r, _ in turns]
        cost, audit = cheapest(marked)
        lines, i, state = [], 0, ""
        for letter in audit:
            if letter != "D":
                role, text = turns[i][1:] if letter != "I" else ("", "")
                role = role if letter == "K" else {"u": "assistant"}.get(state, "user")
                lines.append(f"{role}:{text}")
                state = role[0]
            i += letter != "I"
        out.append((
            conv, known[-1] - known[0] + 1 - len(known) if known else 0, *counts[1:],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def test_op12_query(spark, tmp_path):
    rnd = random.Random(5)
    rows = []
    for conv in range(150):
        for turn in range(rnd.randint(1, 9)):
            role = ("user", "assistant")[turn % 2] if rnd.random() < 0.8 else rnd.choice(["system", "tool", "", None, "user"])
            text = rnd.choice(["Yes.", "No", "Why? ", "\t", "", None, f"Turn {turn}!", f"Turn {turn} of {conv}.\n", "b ", "x" * 70_000 + "."])
            rows.append((conv, rnd.choice([turn] * 9 + [None, turn + 3, 2]), role, text))
    rows += [(500, t, ("user", "assistant")[t % 2], f"Long {t % 190}{'.' if t % 7 else ''}") for t in range(400)]
    rows += [(None, 1, "user", "Hello."), (None, 1, "user", "Hello."), (None, None, None, None)]
    sf = folder(spark, tmp_path, conversations=wide(spark, rows, "conv_id long, turn long, role string, text string"))
    found = QUERIES["op12_repair_conversations"](spark, sf)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted([tuple(r) for r in found.collect()], key=str) == reported(rows)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.repair(empty).collect() == []


def test_op12_on_the_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted([tuple(r) for r in QUERIES["op12_repair_conversations"](spark, SF).collect()], key=str) == reported(rows)


# ---- spelling ----


def variants_by_hand(rows, least=5):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= least}

    def edits(w):
        gone = {w[:i] + w[i + 1 :] for i in range(len(w))}
        letters = {c for v in n for c in v}
        return gone | {w[:i] + c + w[i + k :] for i in range(len(w) + 1) for c in letters for k in (0, 1)}

    near = {w: {v for v in edits(w) if v in n and v != w} for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, n[w], len(near[w]), form.get(w), n[form[w]] if w in form else None, root))
    return sorted(out, key=str)


def spelled(seed):
    rnd = random.Random(seed)
    rows = [(1, " ".join(["".join(rnd.choice("abé") for _ in range(rnd.randint(5, 9)))] * rnd.choice([5, 6, 30, 200]))) for _ in range(250)]
    # halves that end in the middle of a repeat, ties of forms, chains, runs that end at other letters
    rows += [(2, "aaaaaa " * 9 + "aaaaaaa-" * 9 + "AAAAAAAA1" * 50), (3, "OrangeŁorange " * 9 + "oranges " * 300 + "orangess " * 5000)]
    rows += [(4, "z" * 3000 + " "), (4, "z" * 3000 + " "), (4, "z" * 3001 + " "), (None, "×÷Àßÿé " * 6), (None, None), (5, "")]
    return rows + [(4, ("z" * 3000 + " ") * 6 + ("z" * 3001 + " ") * 40)]


@pytest.mark.parametrize("slice_", [16, 1 << 13])
def test_variants_equal_brute_force(spark, slice_):
    rows = spelled(slice_)
    df = wide(spark, rows, "doc_id long, text string")
    found = spelling.group_variants(spelling.word_counts(df, harm=199), slice_)
    assert sorted([tuple(r) for r in found.select("word", "n", "n_near", "form", "form_n", "root").collect()], key=str) == variants_by_hand(rows)


def test_op13_query(spark, tmp_path):
    rows = spelled(2)
    sf = folder(spark, tmp_path, documents=wide(spark, rows, "doc_id long, text string"))
    found = QUERIES["op13_spelling"](spark, sf).select("word", "n", "n_near", "form", "form_n", "root")
    assert sorted([tuple(r) for r in found.collect()], key=str) == variants_by_hand(rows)
    assert spelling.group_variants(spelling.word_counts(spark.createDataFrame([], "doc_id long, text string"))).collect() == []


def test_index_finds_all_words_one_edit_away():
    rnd = random.Random(1)
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 7))) for _ in range(400)})
    index = spelling.Index(words)

    def one_edit(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    for word in [*words[::7], "", "zzzz"]:
        assert [words[i] for i in index.near(word)] == [w for w in words if one_edit(word, w)]
        assert [words[i] for i in index.near(word, 2)] == [w for w in words if one_edit(word, w) and (len(word) < 2 or w[:2] != word[:2])]
