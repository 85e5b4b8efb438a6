"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from directories.

Passages of a text that speak of rights are compared with the statements of each licence as
TF-IDF vectors; the inverse document frequencies are counted over all texts. A passage is
what a sentence has within REACH words of a word on rights; wrapped lines are one sentence,
a blank line or one that begins like a sentence starts another. What of it stands on the
line of that word is a passage too, as not every line that has no full stop goes on. The best cosine of at least
COSINE names the licence of a file; an SPDX header names it exactly, with score 1. Reserved
rights count only where no licence is stated, as licences themselves say so next to their
copyright lines, and a statement that a longer licence has too counts for the longer one if
the text states both. A licence file names the licence of its directory: by its name, or
because it is a licence's text, that is, most of its LICENCE_WORDS or more words stand in
such passages; a short remark is none. A file without a licence of its own takes that of
the nearest directory above it that has one, by joins on paths: each distinct directory
is joined with its own ancestors, and files with their directory, so that no group of
files in one directory meets in one task.

Only the document counts of the template terms go to the driver, and only they and the
templates are shipped to tasks: some hundred numbers at any corpus size.

Defined results: a null or empty text has no licence of its own; a null path has no
directory and inherits nothing; where cosines tie, the earlier template wins; where a
directory has several licence files, the smallest path does, and of rows of that path the
licence that comes first by name; repeated rows each give a row; a very long text is read
whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import slices, texts, written

COSINE = 0.6
#: Words on either side of an anchor, within its sentence.
REACH = 20
#: Share of a text's words in passages, and how many words it has, from which it is a licence's text.
MOSTLY, LICENCE_WORDS = 0.5, 40

#: What a text says that keeps its rights; a licence said anywhere in it goes before this.
RESERVED = "proprietary"

#: Statements of each licence, as headers and licence files have them.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("ISC", "Released under the ISC License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("EPL-2.0", "Licensed under the Eclipse Public License, version 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Released into the public domain under Creative Commons CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    (RESERVED, "Copyright. All rights reserved. No part may be reproduced without permission."),
    (RESERVED, "Copyright. All rights reserved."),
    (RESERVED, "All rights reserved."),
)
#: Licences whose statements another one has as well.
PART_OF = {"BSD-2-Clause": "BSD-3-Clause"}
TERM = re.compile(r"[a-z][a-z0-9]*(?:-[a-z0-9]+)*|[0-9]+(?:\.[0-9]+)*(?:-[a-z]+)?")
VERSION = re.compile(r"\b(?:version|v)\.?\s*([0-9]+(?:\.[0-9]+)*)")
ANCHOR = re.compile(r"licen[sc]|copyright|spdx|public domain|rights reserved|permission|redistribut|creative commons|\bcc[ -]?(?:by|0)\b|©", re.I)
#: An SPDX header; its identifiers, less operators and exceptions, name licences exactly.
SPDX = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.I)
SPDX_ID = re.compile(r"(?<![\w.+-])(?!(?:and|or|with)(?![\w.-]))[a-z0-9][a-z0-9.-]*\+?", re.I)
SPDX_WITH = re.compile(r"\bwith\s+[\w.-]+", re.I)
HINTS = ("licen", "copyright", "spdx", "public domain", "rights reserved", "permission", "redistribut", "creative commons", "cc by", "cc-by", "cc0", "©")
LICENCE_FILE = r"(?i)^(?:un)?licen[sc]es?(?:[-._].*)?$|^copying(?:[-._].*)?$|^copyright(?:[-._].*)?$"


def terms(text: str) -> list[str]:
    """Lower-cased terms; versions are one term with their word, and a final .0 goes."""
    low = VERSION.sub(lambda m: " version" + re.sub(r"(?:\.0)+$", "", m[1]) + " ", text.lower())
    return [re.sub(r"(?:\.0)+$", "", t) if t[0].isdigit() else t for t in TERM.findall(low)]


IDENTIFIERS = {name.lower(): name for name, _ in TEMPLATES if name != RESERVED}


def spdx(text: str) -> str | None:
    """The licence of the first SPDX header of text: the first operand that has templates, or the first as written."""
    m = SPDX.search(text)
    if not m:
        return None
    expression = SPDX_WITH.sub("", re.split(r"\*/|-->|\s[#;*]", m[1])[0])
    found = [re.sub(r"(?i)(?:-only|-or-later|\+)$", "", x).rstrip(".") for x in SPDX_ID.findall(expression)]
    return next((IDENTIFIERS[x.lower()] for x in found if x.lower() in IDENTIFIERS), found[0] if found else None)


VOCABULARY = sorted({t for _, s in TEMPLATES for t in terms(s)})


class Templates:
    """Unit vectors of the statements under given document counts."""

    def __init__(self, counts: dict[str, int], n_docs: int):
        self.idf = {t: math.log((n_docs + 1) / (counts.get(t, 0) + 1)) + 1 for t in VOCABULARY}
        self.other = math.log(n_docs + 1) / 2 + 1  # of a term that no template has
        self.rows = []
        self.inverted: dict[str, list[tuple[int, float]]] = {}
        for k, (name, statement) in enumerate(TEMPLATES):
            for t, w in self.vector(terms(statement)).items():
                self.inverted.setdefault(t, []).append((k, w))
            self.rows.append(name)

    def vector(self, found: list[str]) -> dict[str, float]:
        raw = {t: (1 + math.log(n)) * self.idf.get(t, self.other) for t, n in Counter(found).items()}
        norm = math.sqrt(sum(w * w for w in raw.values())) or 1.0
        return {t: w / norm for t, w in raw.items()}

    def best(self, found: list[str]) -> tuple[str | None, float]:
        """The licence of the most similar statement and its cosine."""
        score = [0.0] * len(self.rows)
        for t, w in self.vector(found).items():
            for k, v in self.inverted.get(t, ()):
                score[k] += w * v
        k = max(range(len(score)), key=lambda i: (round(score[i], 12), -i))
        return (self.rows[k], score[k]) if score[k] > 0 else (None, 0.0)


def sentences(text: str) -> Iterator[tuple[list[str], list[int]]]:
    """The words of each sentence, and the line of each word."""
    words: list[str] = []
    lines: list[int] = []
    for at, line in enumerate(text.split("\n")):
        here = line.split()
        if not here or here[0][0].isupper() and not here[0].isupper():
            if words:
                yield words, lines
            words, lines = [], []
        for w in here:
            words.append(w)
            lines.append(at)
            if w.endswith((".", "!", "?", ";")):
                yield words, lines
                words, lines = [], []
    if words:
        yield words, lines


def around(words: list[str]) -> list[tuple[int, int, int]]:
    """(begin, anchor, end) of the ranges of a sentence within REACH words of its anchors; an anchor inside a range begins no other."""
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    out: list[tuple[int, int, int]] = []
    for m in ANCHOR.finditer(" ".join(words)):
        k = bisect_right(starts, m.start()) - 1
        if not out or k >= out[-1][2]:
            out.append((max(0, k - REACH), k, min(len(words), k + REACH + 1)))
    return out


def speaks(text: str) -> bool:
    low = text.lower()
    return any(h in low for h in HINTS)


def passages(text: str) -> list[list[str]]:
    """The terms of each passage on rights."""
    if not speaks(text):
        return []
    out = []
    for words, lines in sentences(text):
        for i, k, j in around(words):
            out.append(terms(" ".join(words[i:j])))
            own = [w for w, at in zip(words[i:j], lines[i:j], strict=True) if at == lines[k]]
            if len(own) < j - i:
                out.append(terms(" ".join(own)))
    return [p for p in out if p]


def is_licence_text(text: str) -> bool:
    """Whether text is a licence's own: of its words, each counted once, most stand in passages."""
    if not speaks(text):
        return False
    total = said = 0
    for words, _ in sentences(text):
        total += len(words)
        until = 0
        for i, _, j in around(words):
            said += j - max(until, i)
            until = j
    return total >= LICENCE_WORDS and said >= MOSTLY * total


def licence_of(text: str, templates: Templates) -> tuple[str | None, float]:
    """The licence that a text states, and its score."""
    name = spdx(text)
    if name:
        return name, 1.0
    best: dict[str, float] = {}
    for p in passages(text):
        found, s = templates.best(p)
        if s >= COSINE and s > best.get(found, 0.0):
            best[found] = s
    for part, whole in PART_OF.items():
        if part in best and whole in best:
            best[whole] = max(best[whole], best.pop(part))
    # grants before reserved rights, then the score, then the order of the templates
    order = list(dict.fromkeys(n for n, _ in TEMPLATES))
    return max(best.items(), key=lambda x: (x[0] != RESERVED, round(x[1], 12), -order.index(x[0])), default=(None, 0.0))


def document_counts(docs: DataFrame, text: str = "text") -> tuple[dict[str, int], int]:
    """In how many of all texts each template term stands, and the number of texts."""
    known = frozenset(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches):
            counts[""] += batch.num_rows
            for t in texts(batch.column(0)):
                counts.update(known.intersection(terms(t)))
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["term", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r.term: r.n for r in rows}
    return found, found.pop("", 0)


def own_licences(docs: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """key columns, license, score and mostly (whether the text is a licence's own) of every row."""
    counts, n = document_counts(docs, text)
    kinds = docs.select(*key).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds) + ", license string, score double, mostly boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(counts, n)
        for batch in slices(batches):
            whole = texts(batch.column(len(key)))
            names, scores = zip(*(licence_of(t, templates) for t in whole), strict=True)
            scores = [round(s, 9) if n else None for n, s in zip(names, scores, strict=True)]
            mostly = [bool(n) and is_licence_text(t) for n, t in zip(names, whole, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(mostly, pa.bool_())], names=[*key, "license", "score", "mostly"])

    return docs.select(*key, F.col(text)).mapInArrow(run, schema)


def directory(path: Column) -> Column:
    """What stands before the last slash, '' at the top, null for null."""
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", "")).when(path.isNotNull(), "")


def scan(docs: DataFrame, path: Column, key: list[str], text: str = "text") -> DataFrame:
    """key columns, path, license, score and origin ('own', 'inherited' or 'none') of every row."""
    docs = docs.select(*key, path.alias("__path"), text)
    own = written(own_licences(docs, [*key, "__path"], text).withColumn("__dir", directory(F.col("__path"))), "licences")
    is_file = F.regexp_like(F.regexp_replace("__path", "^.*/", ""), F.lit(LICENCE_FILE)) | F.col("mostly")
    by_dir = own.where(is_file & F.col("license").isNotNull() & F.col("__dir").isNotNull()).groupBy("__dir").agg(F.min_by(F.struct("license", "score"), F.struct("__path", "license", "score")).alias("got"))
    dirs = own.where("license is null and __dir is not null").select("__dir").distinct()
    parts = F.split("__dir", "/")
    above = F.when(F.col("__dir") == "", F.array(F.lit(""))).otherwise(
        F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")))
    )
    pairs = dirs.select(F.col("__dir").alias("__below"), F.posexplode(above).alias("depth", "__dir"))
    nearest = written(pairs.join(by_dir, "__dir").groupBy("__below").agg(F.max_by("got", "depth").alias("got")), "nearest")
    out = own.join(nearest, (own["__dir"] == nearest["__below"]) & own["license"].isNull(), "left")
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("got").isNotNull(), "inherited").otherwise("none")
    return out.select(*key, F.col("__path").alias("path"), F.coalesce("license", "got.license").alias("license"), F.coalesce("score", "got.score").alias("score"), origin.alias("origin"))


def op10(docs: DataFrame) -> DataFrame:
    """Documents as files of their source's directory."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")
    path = F.concat(F.coalesce("source", F.lit("")), F.lit("/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return scan(rows, path, ["doc_id"])
