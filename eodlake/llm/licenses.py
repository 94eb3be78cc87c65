"""License scans: headers and licence files against templates, and inheritance along directories.

Lines, windows as long as a template and whole texts become sparse TF-IDF vectors of their distinct words; inverse document
frequencies are taken over all files. Whole texts are first held against full licence texts, then lines and windows against
notices. The best template by cosine at or above the threshold is the file's own licence. Files named like LICENSE, COPYING or
NOTICE, files whose whole text is a full licence text, and short files with a licence speak for their directory; files without
a licence of their own inherit from the nearest one above.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from importlib.resources import files as package_files

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eodlake.llm.common import cut

THRESHOLD = 0.7
#: A file of at most so many words that has a licence is a notice, whatever its name.
NOTICE_WORDS = 40
#: Files of these names are notices at any length.
NOTICE_NAMES = r"(?i)(?:^|/)(?:(?:un)?licen[sc]es?|copying|notice)(?:[._-][^/]*)?$"

#: Names of licences and the words of their usual notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC0-1.0", "Released into the public domain under CC0 1.0"),
    ("Proprietary", "All rights reserved"),
]
_STRIP = b".,;:!?\"'()[]<>*#/"


def full_texts() -> list[tuple[str, str]]:
    """(licence, text) of the licences whose full texts are known."""
    folder = package_files("eodlake.llm") / "license_texts"
    return sorted((f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in folder.iterdir() if f.name.endswith(".txt"))


def terms(text: bytes) -> set[bytes]:
    """Distinct words, A-Z in lower case, without outer punctuation."""
    return {w for w in (x.strip(_STRIP) for x in text.lower().split()) if w}


def sequence(text: bytes) -> tuple[list[bytes], list[int]]:
    """The words of `terms` in order, repeated ones too, and the line of each."""
    found = [(w, i) for i, line in enumerate(text.lower().split(b"\n")) for x in line.split() if (w := x.strip(_STRIP))]
    return [w for w, _ in found], [i for _, i in found]


class Matcher:
    """Templates as unit vectors; finds the best one for a set of words."""

    def __init__(self, templates: list[tuple[str, str]], files: int, frequencies: dict[bytes, int], threshold: float):
        sets = [(name, terms(text.encode())) for name, text in templates]
        self.full: Matcher | None = None
        weigh = lambda n: math.log((files + 1) / (n + 1)) + 1
        self.idf = {w: weigh(frequencies.get(w, 0)) for _, s in sets for w in s}
        self.other = sum(self.idf.values()) / max(1, len(self.idf))
        self.threshold, self.templates, self.anchors = threshold, [], set()
        self.windows = [(frozenset(s), len(sequence(text.encode())[0])) for (_, s), (_, text) in zip(sets, templates, strict=True) if s]
        for name, s in sorted((n, sorted(s)) for n, s in sets if s):
            norm = math.sqrt(sum(self.idf[w] ** 2 for w in s))
            self.templates.append((name, frozenset(s), norm))
            # Without an anchor a text can't reach the threshold: the other words' share of the norm is too small.
            left = (threshold * norm) ** 2
            for w in sorted(s, key=lambda w: (self.idf[w], w)):
                left -= self.idf[w] ** 2
                if left <= 0:
                    self.anchors.add(w)

    def best(self, found: set[bytes]) -> tuple[str, float] | None:
        """(licence, cosine) at or above the threshold; of equal ones the first by name."""
        if self.anchors.isdisjoint(found):
            return None
        known = found & self.idf.keys()
        norm = math.sqrt(math.fsum(self.idf[w] ** 2 for w in known) + self.other**2 * (len(found) - len(known)))
        at = max(((math.fsum(self.idf[w] ** 2 for w in s & known) / (n * norm), name) for name, s, n in self.templates), key=lambda x: (x[0], [-ord(c) for c in x[1]]))
        return (at[1], at[0]) if at[0] >= self.threshold - 1e-12 else None

    def enough(self, found: set[bytes]) -> bool:
        """Whether a part of a text of the words `found` may reach the threshold with some template."""
        return any(math.fsum(self.idf[w] ** 2 for w in s & found) >= (self.threshold * n) ** 2 * (1 - 1e-9) for _, s, n in self.templates)

    def windowed(self, text: bytes, found: set[bytes]) -> Iterator[tuple[tuple[str, float], int]]:
        """(licence, cosine) and first line of the windows, as long as a template, that begin with one of its words."""
        # A window has at most the weight that the text shares with the template.
        share = lambda s: math.fsum(self.idf[w] ** 2 for w in s & found) >= self.threshold**2 * math.fsum(self.idf[w] ** 2 for w in s) * (1 - 1e-9)
        near = [(s, n) for s, n in self.windows if share(s)]
        if near:
            seq, lines = sequence(text)
            for s, n in near:
                for i, w in enumerate(seq):
                    if w in s and (hit := self.best(set(seq[i : i + n]))):
                        yield hit, lines[i]

    def scan(self, text: bytes) -> tuple[str, float, int, bool] | None:
        """(licence, cosine, line, whether the text is a full licence text); the line of the best line or window, -1 for the whole text."""
        found = terms(text)
        if self.full is not None and self.full.enough(found) and (hit := self.full.best(found)):
            return *hit, -1, True
        if self.anchors.isdisjoint(found):
            return None
        hits = [(hit, -1)] if (hit := self.best(found)) else []
        for i, line in enumerate(text.split(b"\n")):
            if hit := self.best(terms(line)):
                hits.append((hit, i))
        hits.extend(self.windowed(text, found))
        if not hits:
            return None
        (name, score), line = max(hits, key=lambda h: (h[0][1], -h[1]))
        return name, score, line, False


def matcher(files: DataFrame, text: str = "text", templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> Matcher:
    """Templates and full licence texts with the document frequencies of their words over all rows of `files`."""
    full = full_texts()
    wanted = frozenset(w for _, t in [*templates, *full] for w in terms(t.encode()))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for t in batch.column(0):
                counts.update(wanted & terms(t.as_py() or b""))
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64())})

    found = files.select(F.col(text).cast("binary")).mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    n, frequencies = files.count(), {bytes(r.word): r.n for r in found}
    known = Matcher(templates, n, frequencies, threshold)
    known.full = Matcher(full, n, frequencies, threshold)
    return known


def scan(files: DataFrame, id_col: str, path: str, text: str, known: Matcher, notice_words: int = NOTICE_WORDS) -> DataFrame:
    """(id, path, license, basis, score, line, from_path) of every row of `files`.

    basis: `own` with the cosine and the line (-1: the whole text), `inherited` with the path of the notice, or null with a
    null licence. Notices of one directory: the highest cosine, then the first path speaks. Null and empty texts have no licence
    of their own; a null path inherits nothing. Repeated rows are judged alike. An empty table gives no rows.
    """
    sent = files.sparkSession.sparkContext.broadcast(known)
    schema = files.select(F.col(id_col).alias("id"), F.col(path).cast("string").alias("path")).schema
    for name, kind in (("license", "string"), ("score", "double"), ("line", "integer"), ("whole", "boolean"), ("n_words", "integer")):
        schema = schema.add(name, kind)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(2)]
            hits = [sent.value.scan(t) or (None, None, None, None) for t in texts]
            columns = [pa.array([h[0] for h in hits], pa.string()), pa.array([h[1] for h in hits], pa.float64()), pa.array([h[2] for h in hits], pa.int32()), pa.array([h[3] for h in hits], pa.bool_()), pa.array([len(t.split()) for t in texts], pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=schema.names)

    own = files.select(F.col(id_col).alias("id"), F.col(path).cast("string").alias("path"), F.col(text).cast("binary").alias("text"))
    own = cut(own.mapInArrow(scanned, schema)).withColumn("folder", F.regexp_extract("path", r"(?s)^(.*)/[^/]*$", 1))
    notices = (
        own.where(F.col("license").isNotNull() & F.col("path").isNotNull())
        .where((F.col("n_words") <= notice_words) | F.col("whole") | F.col("path").rlike(NOTICE_NAMES))
        .groupBy("folder")
        .agg(F.min(F.struct(-F.col("score"), "path", "license")).alias("notice"))
        .select(F.col("folder").alias("above"), "notice.license", "notice.path")
        .toDF("above", "their_license", "from_path")
    )
    # Inheritance is settled for each folder, not for each file; a path has few folders above it.
    folders = own.where(F.col("license").isNull() & F.col("path").isNotNull()).select("folder").distinct()
    parts = F.split("folder", "/")
    uphill = folders.select("folder", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("above"))
    inherited = (
        uphill.distinct().join(notices, "above")
        .groupBy("folder")
        .agg(F.max(F.struct(F.length("above"), "their_license", "from_path")).alias("x"))
        .select("folder", "x.their_license", "x.from_path")
    )
    mine = F.col("license").isNotNull()
    return own.join(inherited, "folder", "left").select(
        "id",
        "path",
        F.coalesce("license", "their_license").alias("license"),
        F.when(mine, "own").when(F.col("their_license").isNotNull(), "inherited").alias("basis"),
        "score",
        "line",
        F.when(~mine, F.col("from_path")).alias("from_path"),
    )
