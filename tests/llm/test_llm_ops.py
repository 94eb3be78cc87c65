"""Operators of the llm folder: against brute force, and with nulls, ties, repeated rows, empty tables and other columns."""

from __future__ import annotations

import hashlib
import os
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from eodlake.llm import decontaminate, licenses, line_dedup, mixing, ngram_join, quality_model, quality_rules, toxicity, url_filters, warc
from eodlake.llm.oracle import ORACLES
from eodlake.llm.queries import QUERIES
from eodlake.llm.setjoin import SetJoin, WordHashes
from eodlake.session import Scratch, shuffles_removed

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, Kept string, token string, c1 string, row string, size string"


def docs(spark, *rows):
    """Rows (doc_id, text[, source]) with further columns that clash with names inside the operators."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "k", "t", "c", "r", "z") for r in rows]
    return spark.createDataFrame(full, DOCS)


def made(n=60, seed=3):
    """Texts with copies, near copies and shared lines."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 5)))
    shared = " ".join(word() for _ in range(12))
    out = []
    for i in range(n):
        if i % 4 == 1:
            text = out[-1][1]
        elif i % 4 == 2:
            words = out[-1][1].split(" ")
            words[rnd.randrange(len(words))] = "Changed"
            text = " ".join(words)
        else:
            text = "\n".join(" ".join(word() for _ in range(rnd.randint(5, 30))) for _ in range(5)) + ("\n" + shared if i % 3 == 0 else "")
        out.append((i, text))
    return [*out, (n, None), (n + 1, ""), (n + 2, "one two"), (n + 3, "One  two"), (n + 4, "\n\n")]


def shingle_components(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(d, least.get(top(i), d))
    return sorted((d, len(sets[i]), least[top(i)]) for i, (d, _) in enumerate(rows))


def lines_removed(rows):
    seen, out = [], {}
    for d, t in rows:
        out[d] = []
        for k, line in enumerate((t or "").encode().lower().split(b"\n")):
            s = set(line.split())
            if len(line.split()) >= line_dedup.MIN_WORDS:
                if any(5 * len(s & x) >= 4 * len(s | x) for x in seen):
                    out[d].append(k)
                seen.append(s)
    return out


def test_ngram_join_against_all_pairs(spark):
    rows = made()
    got = sorted(tuple(r) for r in ngram_join.join_ngrams(docs(spark, *rows)).collect())
    assert got == shingle_components(rows)
    kept = {r.doc_id for r in ngram_join.keep_one(docs(spark, *rows)).collect()}
    assert kept == {d for d, _, c in got if d == c}


def test_line_dedup_against_all_pairs(spark):
    rows = made()
    want = lines_removed(rows)
    got = {r.id: list(r.removed) for r in line_dedup.line_counts(docs(spark, *rows)).collect()}
    assert got == want
    texts = {r.doc_id: r for r in line_dedup.dedup(docs(spark, *rows), n_chars="n_chars").collect()}
    for d, t in rows:
        left = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in want[d])
        if want[d] and not left.split():
            assert d not in texts
        else:
            assert texts[d].text == left and texts[d].n_chars == len(left or "") and texts[d].Kept == "k"


@pytest.mark.parametrize("group_rows", [50_000, 20])
def test_line_dedup_near_the_threshold_and_in_split_groups(spark, monkeypatch, group_rows):
    monkeypatch.setattr(line_dedup, "GROUP_ROWS", group_rows)
    rnd = random.Random(5)
    bases = [[f"w{rnd.randrange(60)}" for _ in range(rnd.randint(5, 25))] for _ in range(6)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(4):
            words = list(rnd.choice(bases))
            for _ in range(rnd.randint(0, 4)):
                words[rnd.randrange(len(words))] = f"w{rnd.randrange(60)}"
            lines.append(" ".join(words))
        rows.append((i, "\n".join(lines)))
    got = {r.id: list(r.removed) for r in line_dedup.line_counts(docs(spark, *rows)).collect()}
    assert got == lines_removed(rows)


def test_word_hashes_are_those_of_the_words_alone():
    raw = ("a  b\tab ba\x0bÄ\n" * 30_000 + "x" * 300_000 + " a").encode()
    starts, hashes = WordHashes().of(raw)
    words = raw.split()
    of = {}
    assert len(words) == len(hashes) and all(raw[p : p + len(w)] == w for p, w in list(zip(starts.tolist(), words, strict=True))[:2000])
    for w, h in zip(words, hashes.tolist(), strict=True):
        assert of.setdefault(w, h) == h
    assert len(set(of.values())) == len(of) and len(WordHashes().of(b"")[1]) == len(WordHashes().of(b" \n")[1]) == 0


def test_joins_without_ids_repeated_rows_and_without_rows(spark):
    text = " ".join(f"w{i}" for i in range(20))
    df = docs(spark, (None, text), (4, text), (4, text), (None, None))
    assert sorted((str(r.id), str(r.component_id)) for r in ngram_join.join_ngrams(df).collect()) == [("4", "4"), ("4", "4"), ("None", "4"), ("None", "None")]
    assert [(r.id, r.n_removed) for r in line_dedup.line_counts(df).where("id is not null").collect()] == [(4, 0), (4, 0)]
    none = docs(spark, (1, "x")).where("doc_id = 0")
    assert ngram_join.join_ngrams(none).count() == line_dedup.removed_lines(none).count() == 0


def test_mixing(spark):
    rows = [(i, "w " * (i % 7), "a" if i < 300 else "b" if i < 320 else None) for i in range(400)]
    df = docs(spark, *rows, (None, None), (9, "w w"), (9, "w w"))
    df = df.withColumns({"words": mixing.text_size("text"), "place": mixing.seeded(1, "doc_id", "text")})
    mix = lambda: mixing.mix(df, F.col("words"), F.array("source"), F.col("place"), tie=("doc_id",)).collect()
    got = mix()
    assert sorted(map(str, got)) == sorted(map(str, mix())) and len(got) == 403
    taken, target, size = Counter(), {}, Counter()
    for r in got:
        assert r.taken <= 3 * r["size"] and r.row.Kept == "k"
        taken[r.row.source] += r.taken
        size[r.row.source] += r["size"]
        target[r.row.source] = r.target[0]
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    for s in target:
        assert abs(taken[s] - target[s]) <= 6 and target[s] <= 3 * size[s]
    assert mixing.mix(df.where("false"), F.col("words"), F.array("source"), F.col("place")).count() == 0


def test_flow_uses_other_routes_before_it_repeats():
    sent = mixing.route({"ab": (["a", "b"], 10), "a": (["a"], 10)}, {"a": 10, "b": 10}, 3)
    assert sent == {"ab": {"a": 0, "b": 10}, "a": {"a": 10}}


def test_decontamination(spark):
    item = "Anna bought 12 red apples for 30 dollars and gave 12 of them to the old man"
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "a b c")], "item_id long, text string")
    other = item.replace("12", "57").replace("30", "8").replace("Anna", "Lena")
    broken = item.replace("12 red", "57 red")  # a copy but for one of two equal numbers
    rows = [
        (1, f"before that. {item}! and after"), (2, "Well. " + other), (3, broken), (4, "nothing of the kind is told here"),
        (5, None), (6, ""), (7, "so A b c!"), (8, " ".join(str(i) for i in range(50))), (None, item), (None, "fine words only"),
        (9, "now 12 17, 19 23 29 31 then"), (10, "now 12 17 18 23 29 31 then"), (1, "the same id, another text"),
    ]
    bench = bench.union(spark.createDataFrame([(5, "12 17 19 23 29 31")], bench.schema))
    found = decontaminate.leaks(docs(spark, *rows), bench)
    got = {(r.doc_key.id, r.item): r.other_values for r in found.collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 1), (7, 4), (None, 1), (9, 5)}
    assert got[1, 1] == got[9, 5] == 0 and got[2, 1] >= 2
    clean = decontaminate.clean(docs(spark, *rows), bench)
    assert sorted(str(r.doc_id) for r in clean.collect()) == ["1", "10", "4", "5", "6", "8", "None"]
    assert decontaminate.leaks(docs(spark, *rows), bench.where("false")).count() == 0
    assert decontaminate.leaks(docs(spark, *rows).where("false"), bench).count() == 0


def test_warc_round_trip(spark, tmp_path):
    long = "é" * 600
    rows = [(1, "http://a/", long), (3, None, long), (2, "http://b/\r\nx", "short"), (5, "u", None), (7, "u", "short"), (None, "v", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("other"))
    folder = f"file://{tmp_path}/warc"
    back = warc.read_warc(warc.write_warc(pages, folder), folder).collect()
    got = {r.record_id: (r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, r.digest_ok) for r in back}
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    assert got["urn:page:1"] == ("revisit", "urn:page:3", 1200, sha(long), True)
    assert got["urn:page:3"] == got["urn:page:"] == ("response", None, 1200, sha(long), True)
    assert got["urn:page:2"] == got["urn:page:7"] == ("response", None, 5, sha("short"), True)
    assert got["urn:page:5"] == ("response", None, 0, sha(""), True)
    assert {bytes(r.payload) for r in back if r.payload is not None} == {long.encode(), b"short", b""}
    with pytest.raises(ValueError):
        warc.parse(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n")
    assert warc.read_warc(warc.write_warc(pages.where("false"), folder), folder).count() == 0


def test_cascade(spark):
    good = " ".join(f"word{i}" for i in range(30))
    rows = [(1, good), (2, "few"), (3, None), (4, "aa bb cc dd ee " * 10), (5, "a*** " * 30), (6, good.upper()), (1, good)]
    df = quality_rules.cascade(docs(spark, *rows), "text", facts=("n_words",))
    assert [(r.doc_id, r.kept_) for r in df.select("doc_id", "kept_").collect()] == [(i, i == 1) for i in (1, 2, 3, 4, 5, 6, 1)]
    dear, cheap = quality_rules.Measured(quality_rules.RULES[0], 1.0, 0.5), quality_rules.Measured(quality_rules.RULES[1], 0.1, 0.2)
    assert quality_rules.ordered([dear, cheap]) == [cheap.rule, dear.rule]
    assert quality_rules.cascade(docs(spark, *rows).where("false"), "text").count() == 0


def test_url_aliases(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [
        (1, "http://bad.org/x", ""), (2, "https://mirror.net/y", link.format("http://bad.org/x")), (3, "http://fine.net/", None),
        (4, "http://ok.net/z", "<meta http-equiv='refresh' content='0; url=http://bad.org/w'>"), (5, None, ""), (6, "nothing", "x"),
        (7, "http://m2.net/", link.format("//ok.net/z#top")), (8, "http://bad.org/w", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("verdict", F.lit("x"))
    rules = spark.createDataFrame([("bad.org", "/", "block"), ("ok.net", "/z", "allow")], "host string, path string, action string")
    redirects = spark.createDataFrame([("http://m3.net/", "https://mirror.net/y"), (None, "x")], "url string, target string")
    got = {r.page_id: (r.verdict, r.rule) for r in url_filters.filter_urls(pages, rules, redirects).collect()}
    assert got == {
        1: ("block", "bad.org/"), 2: ("block", None), 3: ("allow", None), 4: ("allow", "ok.net/z"), 5: ("allow", None), 6: ("allow", None),
        7: ("allow", None), 8: ("block", "bad.org/"),
    }


def test_classifiers_on_held_out_texts(spark):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("aeioutnsr") for _ in range(rnd.randint(3, 8)))
    text = lambda bad: " ".join("blockhead" if bad and i % 15 == 3 else word() for i in range(120))
    rows = [(text(i % 2), i % 2) for i in range(600)]
    df = spark.createDataFrame(rows, "text string, label int")
    test = spark.createDataFrame([(i, text(i % 2)) for i in range(100)] + [(None, None), (7, "")], "doc_id long, text string")
    for module in (quality_model, toxicity):
        scored = module.score(test, module.fit(df)).collect()
        assert all(0 <= r.score <= 1 for r in scored) and len(scored) == 102
        right = sum((r.score >= 0.5) == bool(r.doc_id % 2) for r in scored[:100])
        assert right >= 90, (module.__name__, right)
        assert module.score(test, module.fit(df.where("false"))).count() == 102


def test_licenses(spark):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.py", "# code\n# Licensed under the Apache License, Version 2.0.\nrun()"),
        (3, "a/b/y.py", "just some code"), (4, "c/z.py", "more code"), (5, None, None), (6, "a/b/c/d.py", ""), (3, "a/b/y.py", "just some code"),
    ]
    files = spark.createDataFrame(rows, "id long, path string, text string").withColumn("license", F.lit("x"))
    got = {r.id: (r.license, r.basis) for r in licenses.scan(files, "id", "path", "text", licenses.matcher(files), notice_words=8).collect()}
    assert got == {1: ("MIT", "own"), 2: ("Apache-2.0", "own"), 3: ("MIT", "inherited"), 4: (None, None), 5: (None, None), 6: ("MIT", "inherited")}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(repr, cursor.fetchall()))


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_pipeline(spark):
    import corpus_pipeline

    source = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "text", "lang", "source", "n_chars", "copies", "taken"} <= set(got.columns)
    rows = got.collect()
    assert 0 < len(rows) < len(source) and {r.doc_id for r in rows} <= {d for d, _ in source}
    components = Counter(c for _, _, c in shingle_components([(r.doc_id, r.text) for r in rows]))
    assert max(components.values()) == 1


def test_toxic_dictionary_of_few_texts_and_of_many_words():
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("aeioutnsr") for _ in range(rnd.randint(3, 8)))
    ordinary = [" ".join(word() for _ in range(120)).encode() for _ in range(80)]
    few, other = toxicity.dictionaries([b"you utter blockhead, nothing else", b"a blockhead of the worst kind"], ordinary, 1)
    assert b"blockhead" in few and b"blockhead" not in other and len(few) == len(other)
    rude = [b"rude%05d" % i for i in range(3000)]
    many, other = toxicity.dictionaries([b" ".join(rude)] * 4, ordinary, 1)
    assert all(b" " + w + b" " in many for w in rude) and len(many) == len(other)


def test_toxic_thresholds_come_from_the_calibration_texts():
    found = []
    for insult in ("blockhead", "blockheadedly-unreasonable"):
        rnd = random.Random(1)
        word = lambda: "".join(rnd.choice("aeioutnsr") for _ in range(rnd.randint(3, 8)))  # noqa: B023, E731
        texts = [" ".join(insult if i % 2 and k % 15 == 3 else word() for k in range(120)).encode() for i in range(300)]
        y = [i % 2 for i in range(300)]
        model = toxicity.Model(*toxicity.dictionaries([t for t, x in zip(texts[:150], y) if x], [t for t, x in zip(texts[:150], y) if not x], 1))
        model.start()
        model.calibrate(texts[150:], np.array(y[150:]))
        found.append(model.thresholds)
    assert max(found[1]) > max(found[0])


def test_line_dedup_of_short_lines(spark):
    lines = ["a", "b a", "A", "a b", "a  a", "one two three four", "x one two three", "One two three four five", "four three two one", "three two one", "", "p q r s t", "p q r s", "k l m", "k l n"]
    rows = [(i, "\n".join(lines[i:] + lines[:i])) for i in range(2)] + [(2, lines[5]), (3, "A B"), (4, "z"), (5, "x y z\nz")]
    seen, want = [], {}
    for d, t in rows:
        want[d] = []
        for k, s in enumerate(set(x.lower().split()) for x in t.split("\n")):
            if any(10 * len(s & x) >= 8 * len(s | x) for x in seen if s):
                want[d].append(k)
            seen.append(s)
    assert want[3] == [0] and want[5] == [1] and {2, 3, 4, 7, 8, 12} <= set(want[0])
    got = {r.id: list(r.removed) for r in line_dedup.line_counts(docs(spark, *rows)).collect()}
    assert got == want
    assert {r.doc_id for r in line_dedup.dedup(docs(spark, *rows)).collect()} == {0, 4, 5}


def test_near_copies_stage_takes_five_words_and_four_fifths(spark):
    import corpus_pipeline

    rnd = random.Random(4)
    rows = []
    for i in range(40):
        if i % 2 and i > 2:
            words = rows[-1][1].split()
            for _ in range(rnd.randint(1, 2)):
                words[rnd.randrange(len(words))] = f"new{i}"
        else:
            words = [f"w{rnd.randrange(500)}" for _ in range(rnd.randint(40, 120))]
        rows.append((i, " ".join(words)))
    base = [f"x{i}" for i in range(50)]
    rows += [(50, " ".join(base)), (51, " ".join([*base[:25], "other", *base[26:]])), (52, "one two three"), (53, "One two  three"), (54, None), (55, "")]
    sets, kept = [], set()
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    group = list(range(len(rows)))
    for _ in rows:  # until nothing moves
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 10 * len(a & b) >= 8 * len(a | b):
                    group[i] = group[j] = min(group[i], group[j])
    kept = {rows[i][0] for i, g in enumerate(group) if g == i}
    assert not {51, 53} & kept and {50, 52, 54, 55} <= kept
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, docs(spark, *rows), SF).collect()} == kept


def test_license_files_of_any_length_and_wrapped_notices(spark):
    full = dict(licenses.full_texts())
    filler = "\n".join(f"value{i} = compute{i}" for i in range(60))
    header = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU {} General Public License as published\n# by the Free Software Foundation\n"
    rows = [
        (1, "mit/LICENSE", "Copyright (c) 2020 Somebody Else\n\n" + full["MIT"]), (2, "mit/src/a.py", filler),
        (3, "gpl/docs/terms.txt", full["GPL-3.0"]), (4, "gpl/docs/b.py", filler), (5, "gpl2/COPYING", full["GPL-2.0"]),
        (6, "x/wrapped.py", f"{filler}\n# Licensed under the Apache\n# License, Version 2.0\n{filler}"), (7, "x/c.py", filler),
        (8, "x/long.py", filler.replace("\n", " ") + " Released under the MIT License " + filler.replace("\n", " ")),
        (9, "y/affero.py", header.format("Affero") + filler), (10, "y/lesser.py", header.format("Lesser") + filler), (11, "y/plain.py", header.replace("{} ", "") + filler),
        (12, "z/NOTICE.txt", f"{filler}\nReleased under the MIT License\n{filler}"), (13, "z/d.py", filler),
    ]
    files = spark.createDataFrame(rows, "id long, path string, text string")
    got = {r.id: (r.license, r.basis) for r in licenses.scan(files, "id", "path", "text", licenses.matcher(files)).collect()}
    assert got == {
        1: ("MIT", "own"), 2: ("MIT", "inherited"), 3: ("GPL-3.0", "own"), 4: ("GPL-3.0", "inherited"), 5: ("GPL-2.0", "own"), 6: ("Apache-2.0", "own"),
        7: (None, None), 8: ("MIT", "own"), 9: ("AGPL-3.0", "own"), 10: ("LGPL-3.0", "own"), 11: ("GPL-3.0", "own"), 12: ("MIT", "own"), 13: ("MIT", "inherited"),
    }


def test_punctuation_of_slot_values_does_not_count(spark):
    item = "then Anna gave 12 ripe apples to the old man by the sea and so Anna kept 12 for the way home"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [
        (1, item.replace("then Anna", "then Anna,").replace("gave 12", "gave (12)")), (2, item.replace("Anna kept 12", "Anna! kept 12,")),
        (3, item.replace("kept 12", "kept -12").replace("gave 12", "gave +12")), (4, item),
    ]
    got = {r.doc_key.id: r.other_values for r in decontaminate.leaks(docs(spark, *rows), bench).collect()}
    # signs belong to the value: row 3 has another one, and loses the windows of the rarer of its two
    assert got == {1: 0, 2: 0, 3: 1, 4: 0}


def test_rows_without_an_id_or_with_a_repeated_one_lose_no_text_of_their_own(spark):
    """A, and texts that nothing else has, under no id and under one id twice."""
    same = "every word of this first line is here again"
    alone = ["quite another story about ships and their crews", "mountains of paper stood on the old wooden desk"]
    rows = [(1, same), (None, same), (None, alone[0]), (7, same), (7, alone[1]), (7, alone[1])]
    left = [(r.doc_id, r.text) for r in line_dedup.dedup(docs(spark, *rows)).collect()]
    assert sorted(left, key=str) == sorted([(1, same), (None, alone[0]), (7, alone[1]), (7, alone[1])], key=str)
    left = [(r.doc_id, r.text) for r in ngram_join.keep_one(docs(spark, *rows), words=5, num=80, den=100).collect()]
    assert sorted(left, key=str) == sorted([r for r in rows if r != (7, same)], key=str)


def test_registered_ngram_join_with_hot_groups(spark, tmp_path):
    """Whole written table, by the registered query: near copies of one original, a chain of near copies, a passage that many share."""
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    base, passage = [word() for _ in range(90)], " ".join(word() for _ in range(60))
    rows = []
    for i in range(70):  # from near to beyond the threshold
        words = list(base)
        for _ in range(i % 6):
            words[rnd.randrange(len(words))] = word()
        rows.append((i, " ".join(words)))
    chain = [word() for _ in range(80)]
    for i in range(70, 85):  # each like the one before, the last unlike the first
        chain[(i - 70) * 4] = word()
        rows.append((i, " ".join(chain)))
    rows += [(i, f"{passage} {' '.join(word() for _ in range(i % 30 + 1))}") for i in range(85, 125)]
    rows += [(125, None), (126, ""), (127, "one two"), (128, "One  two"), (129, " ".join(base * 300))]
    docs(spark, *rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op3_ngram_join"](spark, str(tmp_path)).select("doc_id", "n_shingles", "component_id")
    assert sorted(tuple(r) for r in got.collect()) == shingle_components(rows)


def test_sketches_differ_in_no_more_bits_than_sets_in_tokens():
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice("abcdef") for _ in range(rnd.randint(0, 60))).encode() for _ in range(40)]
    sets = ngram_join.shingles()(texts)
    found = ngram_join.sketches(sets)
    tokens = [set(sets.tokens[e - n : e].tolist()) for e, n in zip(sets.ends.tolist(), sets.size.tolist(), strict=True)]
    for i, a in enumerate(tokens):
        for j, b in enumerate(tokens):
            apart = sum(((int(s[i]) ^ int(s[j])) & ((1 << 64) - 1)).bit_count() for s in found.values())
            assert apart <= len(a ^ b)


def test_the_nearest_of_another_component_is_named():
    rnd = np.random.default_rng(6)
    size = 200
    rows = {"token": np.sort(rnd.integers(0, 8, size)), "salt": np.zeros(size, np.int64), "n": rnd.integers(40, 50, size), "at": rnd.integers(0, 6, size)}
    rows |= {"r1": rnd.integers(0, 3, size), "r2": rnd.integers(0, 2, size)} | {k: rnd.integers(0, 8, size) for k in ngram_join.SKETCH}
    found, apart = ngram_join.closest(rows, 85, 100)
    r = [dict(zip(rows, x, strict=True)) for x in zip(*(v.tolist() for v in rows.values()), strict=True)]
    for k, b in enumerate(r):
        want = []
        for a in r:
            d, both = sum((a[s] ^ b[s]).bit_count() for s in ngram_join.SKETCH), a["n"] + b["n"]
            fits = 100 * min(a["n"], b["n"]) >= 85 * max(a["n"], b["n"]) and 185 * min(a["n"] - a["at"], b["n"] - b["at"]) >= 85 * both
            if a["token"] == b["token"] and (a["r1"], a["r2"]) != (b["r1"], b["r2"]) and fits and 185 * d <= 15 * both:
                want.append(d)
        want = sorted(want)[:2]
        assert [int(d) for d, i in zip(apart[k], found[k], strict=True) if i >= 0] == want


def test_shuffle_files_go_with_a_lean_write(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with shuffles_removed(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == before
    with Scratch(spark, lean=True) as scratch:
        assert scratch.write(spark.range(10).repartition(3, "id")).count() == 10


def test_rows_asked_for_meet_all_earlier_ones_of_their_group():
    rnd = np.random.default_rng(4)
    size = 300
    rows = {"token": np.sort(rnd.integers(0, 6, size)), "n": rnd.integers(4, 9, size), "at": rnd.integers(0, 2, size), "id": rnd.integers(0, 40, size)}
    rows |= {"record": np.arange(size), "c1": np.arange(size), "s1": rnd.integers(0, 4, size), "s2": rnd.integers(0, 2, size)}
    rows = line_dedup.one_each(rows)
    asked = rnd.random(size) < 0.2
    got = line_dedup.all_near(rows, asked, 4, 5)
    r = [dict(zip(rows, x, strict=True)) for x in zip(*(v.tolist() for v in rows.values()), strict=True)]
    want = set()
    for k, b in enumerate(r):
        for a in r if asked[k] else []:
            apart, both = (a["s1"] ^ b["s1"]).bit_count() + (a["s2"] ^ b["s2"]).bit_count(), a["n"] + b["n"]
            fits = 5 * min(a["n"], b["n"]) >= 4 * max(a["n"], b["n"]) and 9 * min(a["n"] - a["at"], b["n"] - b["at"]) >= 4 * both
            if a["token"] == b["token"] and (a["id"], a["record"]) < (b["id"], b["record"]) and fits and 9 * apart <= both:
                want.add((b["id"], b["record"], a["id"], a["record"]))
    assert want and set(zip(*(got[k].tolist() for k in line_dedup.PAIR), strict=True)) == want


def test_a_replaced_scratch_table_goes(spark):
    with Scratch(spark) as scratch:
        first = scratch.write(spark.range(3))
        second = scratch.write(first.withColumn("x", F.col("id") + 1), first)
        kept = os.listdir(scratch.path.removeprefix("file:"))
        assert kept == ["2"] and second.count() == 3


def test_rows_of_lengths_that_fit_no_other_of_their_token_go(spark):
    class Lengths(SetJoin):
        num, den = 85, 100

        def __init__(self):
            pass

    # token, salt, c1, c2, n, at: sizes 100 and 117 fit up to place 7 of the smaller one, 100 and 118 never do
    rows = [(1, 0, 1, 1, 100, 0), (1, 0, 2, 2, 117, 0), (2, 0, 1, 1, 100, 0), (2, 0, 2, 2, 118, 0), (3, 1, 1, 1, 100, 0),
            (4, 0, 1, 1, 100, 9), (4, 0, 2, 2, 117, 0), (5, 0, 1, 1, 50, 0), (5, 0, 2, 2, 100, 0), (5, 0, 3, 3, 100, 0)]
    kept = ngram_join._of_fitting_length(Lengths(), spark.createDataFrame(rows, "token long, salt int, c1 long, c2 long, n int, at int"))
    assert sorted((r.token, r.c1) for r in kept.collect()) == [(1, 1), (1, 2), (3, 1), (4, 2), (5, 2), (5, 3)]


def test_partners_are_kept_in_one_shuffle_of_their_rows(spark):
    class Lengths(SetJoin):
        num, den = 85, 100

        def __init__(self):
            pass

    like, other = [0] * 8, [-1] * 8
    rows = [(1, 0, 1, 1, 100, 0, 1, 1, 5, 2, *like), (1, 0, 2, 2, 100, 0, 2, 2, 6, 2, *like), (2, 0, 1, 1, 100, 1, 1, 1, 5, 2, *like), (2, 0, 3, 3, 100, 1, 3, 3, 7, 2, *other)]
    columns = [*ngram_join.ROW[:9], "many", *ngram_join.SKETCH]
    kept = ngram_join._with_partners(Lengths(), spark.createDataFrame(rows, ", ".join(f"{k} long" for k in columns)))
    assert sorted((r.token, r.c1, r.central) for r in kept.collect()) == [(1, 1, 5), (1, 2, 6)]
    assert kept._jdf.queryExecution().sparkPlan().toString().count("Join") == 0


@pytest.mark.parametrize("pairs", [1_000_000, 7])
def test_open_lines_meet_earlier_ones_where_these_are_listed(monkeypatch, pairs):
    monkeypatch.setattr(line_dedup, "PAIRS", pairs)
    rnd = np.random.default_rng(5)
    size = 300
    rows = {"token": np.sort(rnd.integers(0, 6, size)), "n": rnd.integers(4, 12, size), "at": rnd.integers(0, 2, size), "id": rnd.integers(0, 40, size)}
    rows |= {"record": np.arange(size), "c1": np.arange(size), "s1": rnd.integers(0, 4, size), "s2": rnd.integers(0, 2, size)}
    rows = line_dedup.one_each(rows)
    asked = (rnd.random(size) < 0.2) & (rows["token"] != 3)
    want = line_dedup.all_near(rows, asked, 4, 5)
    open_ = line_dedup.OpenRows({k: v[asked] for k, v in rows.items()}, 4, 5)
    known = open_.known(rows["token"])
    assert known.tolist() == np.isin(rows["token"], rows["token"][asked]).tolist()
    got = list(open_.later({k: v[known] for k, v in rows.items()}))
    pairs_of = lambda x: set(zip(*(x[k].tolist() for k in line_dedup.PAIR), strict=True))
    assert pairs_of(want) and set().union(*map(pairs_of, got)) == pairs_of(want)
    assert list(open_.later({k: v[:0] for k, v in rows.items()})) == []


def test_open_lines_pick_the_lines_to_rank():
    """Before lines are ranked and sorted, those without a token of an open line go; none that has one does."""
    rnd = np.random.default_rng(6)
    size = rnd.integers(0, 9, 400)
    tokens = rnd.integers(0, 1 << 63, int(size.sum())).astype(np.uint64) * np.uint64(2)
    sets = line_dedup.Sets(np.arange(400) // 3, np.arange(400) % 3, size, tokens)
    ranked = (np.uint64(5) << np.uint64(57) | tokens >> np.uint64(7)).view(np.int64)
    own = ranked[rnd.choice(len(ranked), 12, replace=False)]
    rows = {k: np.zeros(12, np.int64) for k in (*line_dedup.PLACE, *line_dedup.CLASS, "at")} | {"token": own, "n": np.full(12, 5)}
    got = line_dedup.OpenRows(rows, 4, 5).near(sets)
    has = [i for i, (end, n) in enumerate(zip(sets.ends, size, strict=True)) if np.isin(ranked[end - n : end], own).any()]
    kept = dict(zip((got.text * 3 + got.number).tolist(), np.split(got.tokens, got.ends[:-1]), strict=True))
    assert set(has) <= set(kept) and len(kept) < len(has) + 5
    assert all(np.array_equal(kept[i], tokens[sets.ends[i] - size[i] : sets.ends[i]]) for i in has)


def test_line_dedup_reads_few_texts_more_than_twice(spark):
    """Texts are split once to list lines, once for their prefixes; later only those with a line that is compared."""
    read = spark.sparkContext.accumulator(0)

    def splitter():
        split = line_dedup.line_sets()

        def counted(texts):
            read.add(len(texts))
            return split(texts)

        return counted

    rows = [(i, " ".join(f"w{i}x{k}" for k in range(12))) for i in range(200)]
    rows.append((200, rows[3][1].replace("w3x4", "other")))
    with Scratch(spark) as scratch:
        join = line_dedup.LineJoin(docs(spark, *rows), "doc_id", "text", splitter, 4, 5, 16, scratch)
        assert [tuple(r) for r in join.matched().collect()] == [(200, 0)]
    assert read.value == 2 * 201 + 2
