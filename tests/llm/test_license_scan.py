import math
import re
from collections import Counter

from pyspark.sql import functions as F

from corpusmill.llm.license_scan import ANCHOR, COSINE, LICENCE_WORDS, MOSTLY, REACH, TEMPLATES, op10, scan

LINES = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.", "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0."}


def plain_terms(text):
    """The terms of a text, read anew: versions belong to their word, and a final .0 goes."""
    low = re.sub(r"\b(?:version|v)\.?\s*([0-9]+(?:\.[0-9]+)*)", lambda m: f" version{re.sub('([.]0)+$', '', m[1])} ", text.lower())
    found = re.findall(r"[a-z][a-z0-9]*(?:-[a-z0-9]+)*|[0-9]+(?:\.[0-9]+)*(?:-[a-z]+)?", low)
    return [re.sub(r"([.]0)+$", "", t) if t[0].isdigit() else t for t in found]


def plain_sentences(text):
    """Sentences, as (word, line) pairs, by marks at the ends of words, blank lines, and lines that begin like one."""
    out = [[]]
    for at, x in enumerate(text.split("\n")):
        if not x.split() or x.split()[0][0].isupper() and not x.split()[0].isupper():
            out.append([])
        for w in x.split():
            out[-1].append((w, at))
            if w[-1] in ".!?;":
                out.append([])
    return [s for s in out if s]


def anchored(pairs):
    joined = " ".join(w for w, _ in pairs)
    return sorted({joined[: m.start()].count(" ") for m in ANCHOR.finditer(joined)})


def plain_windows(pairs):
    taken, out = [], []
    for k in anchored(pairs):
        if not taken or k > taken[-1] + REACH:
            taken.append(k)
            window = pairs[max(0, k - REACH) : k + REACH + 1]
            out += [[w for w, _ in window], [w for w, at in window if at == pairs[k][1]]]
    return taken, out


def brute(rows):
    """path -> (license, origin) by plain dense vectors over all terms and walking up the directories."""
    n = len(rows)
    vocabulary = {t for _, s in TEMPLATES for t in plain_terms(s)}
    df = Counter(t for _, text in rows for t in set(plain_terms(text or "")) & vocabulary)

    def vector(found):
        v = {t: (1 + math.log(c)) * (math.log((n + 1) / (df[t] + 1)) + 1 if t in vocabulary else math.log(n + 1) / 2 + 1) for t, c in Counter(found).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}

    def own(text):
        best = {}
        for words in plain_sentences(text or ""):
            for window in plain_windows(words)[1]:
                v = vector(plain_terms(" ".join(window)))
                c, _, name = max((round(sum(v.get(t, 0) * x for t, x in vector(plain_terms(s)).items()), 12), -k, name) for k, (name, s) in enumerate(TEMPLATES))
                if c >= COSINE:
                    best[name] = max(c, best.get(name, 0))
        if "BSD-2-Clause" in best and "BSD-3-Clause" in best:
            del best["BSD-2-Clause"]
        grants = {k: v for k, v in best.items() if k != "proprietary"} or best
        return max(grants, key=lambda k: (grants[k], -[name for name, _ in TEMPLATES].index(k)), default=None)

    def is_file(path, text):
        name = path.rpartition("/")[2].lower()
        parts = plain_sentences(text or "")
        near = sum(len({i for k in plain_windows(w)[0] for i in range(max(0, k - REACH), min(len(w), k + REACH + 1))}) for w in parts)
        total = sum(map(len, parts))
        return name.startswith(("license", "copying")) or total >= LICENCE_WORDS and near >= MOSTLY * total

    found = {p: own(t) for p, t in rows}
    dirs = {p.rpartition("/")[0]: found[p] for p, t in sorted(rows, reverse=True) if found[p] and is_file(p, t)}
    out = {}
    for p, name in found.items():
        d, origin = p.rpartition("/")[0], "own"
        while not name:
            if d in dirs:
                name, origin = dirs[d], "inherited"
            elif not d:
                origin = "none"
                break
            else:
                d = d.rpartition("/")[0]
        out[p] = (name, origin)
    return out


def test_against_brute_force(spark):
    prose = "some ordinary words about nothing in particular that go on for a while"
    rows = [(f"a/b/f{k}.txt", f"{prose}.\n{line}\n{prose}") for k, line in enumerate(LINES.values())]
    rows += [("a/LICENSE", "MIT License. Released under the MIT License."), ("a/b/c/x", prose), ("a/b/COPYING", LINES["GPL-3.0"]), ("z/y", prose), ("top", None), ("a/x", "All the licence talk of this text is prose " + prose), ("a/b/c/d/long", prose * 40 + ". " + LINES["Apache-2.0"] + " " + prose * 40)]
    rows += [("w/1", GRANT), ("w/2", prose), ("w/v/3", prose), ("v/1", BSD), ("v/2", "Copyright 2020 X. " + prose)]
    df = spark.createDataFrame(rows, "p string, text string").withColumn("license", F.lit("x"))
    got = {r.path: (r.license, r.origin) for r in scan(df.drop("license"), F.col("p"), ["p"]).collect()}
    assert got == brute(rows)
    assert got["a/b/c/x"] == ("GPL-3.0", "inherited") and got["a/x"] == ("MIT", "inherited") and got["z/y"] == (None, "none") and got["a/b/c/d/long"] == ("Apache-2.0", "own")


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in op10(docs).collect()}
    n = 0
    for r in docs.collect():
        said = [k for k, line in LINES.items() if line in r.text]
        n += len(said)
        reserved = "All rights reserved." in r.text
        assert (got[r.doc_id].license in said) if said else (got[r.doc_id].license, got[r.doc_id].origin) == (("proprietary", "own") if reserved else (None, "none")), r.doc_id
    assert n > 10 and len(got) == docs.count()


def test_edges(spark):
    mit = LINES["MIT"]
    rows = [(None, None, None, "q"), (1, "", "s", "q"), (1, "", "s", "q"), (2, "license " * 50_000, "s", "q"), (3, mit, "t", "q"), (3, mit, "t", "q"), (4, "plain", "t", "q"), (None, mit, None, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, path string").withColumn("__dir", F.lit("x"))
    got = sorted(((r.doc_id, r.license, r.origin) for r in op10(df).collect()), key=str)
    # a short remark licenses its own document, repeated or not, and no other one
    assert got == sorted([(None, None, "none"), (1, None, "none"), (1, None, "none"), (2, None, "none"), (3, "MIT", "own"), (3, "MIT", "own"), (4, None, "none"), (None, "MIT", "own")], key=str)
    assert op10(df.limit(0)).count() == 0


def test_ties(spark):
    """Two licence files of one path: the licence that comes first by name; two statements of one file: the better cosine."""
    gpl, mit = LINES["GPL-3.0"], LINES["MIT"]
    rows = [("a/LICENSE", mit), ("a/LICENSE", gpl), ("a/x", "plain"), ("b/COPYING", gpl), ("b/LICENSE", mit), ("b/x", "plain")]
    got = {r.path: r.license for r in scan(spark.createDataFrame(rows, "p string, text string").repartition(3), F.col("p"), ["p"]).collect()}
    assert got["a/x"] == "GPL-3.0" and got["b/x"] == "GPL-3.0"


def test_reserved_rights(spark):
    prose = "some ordinary words about nothing in particular that go on for a while"
    said = ["All rights reserved.", "Copyright. All rights reserved.", "Copyright 2024 Acme Inc. All rights reserved.", "(c) Acme. All Rights Reserved"]
    rows = [(f"a/{k}", f"{prose}.\n{line}\n{prose}") for k, line in enumerate(said)]
    rows += [("b/bsd", f"{prose}\nCopyright 2024 Acme Inc. All rights reserved.\nReleased under the BSD 3-Clause License.\n{prose}"), ("b/one", f"{prose}\nAll rights reserved. Released under the MIT License.\n{prose}"), ("c/plain", prose)]
    got = {r.path: (r.license, r.origin) for r in scan(spark.createDataFrame(rows, "p string, text string"), F.col("p"), ["p"]).collect()}
    assert all(got[f"a/{k}"] == ("proprietary", "own") for k in range(len(said)))
    assert got["b/bsd"] == ("BSD-3-Clause", "own") and got["b/one"] == ("MIT", "own") and got["c/plain"] == (None, "none")


def test_reserved_rights_in_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in op10(docs).collect()}
    only = [r.doc_id for r in docs.collect() if "All rights reserved." in r.text and not any(line in r.text for line in LINES.values())]
    assert only and all((got[i].license, got[i].origin) == ("proprietary", "own") for i in only)


SPDX = {"Apache-2.0": "Apache-2.0", "GPL-3.0-only": "GPL-3.0", "GPL-2.0+": "GPL-2.0", "LGPL-2.1-or-later": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "bsd-3-clause": "BSD-3-Clause", "(Zlib OR MIT)": "MIT", "Zlib": "Zlib", "GPL-2.0-only WITH Classpath-exception-2.0": "GPL-2.0", "MIT */": "MIT"}
GRANT = """Copyright (c) 2024 Acme Inc.

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
BSD = """Copyright (c) 2024, Acme Inc. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def test_spdx_and_whole_licences(spark):
    prose = "Some ordinary words about nothing in particular that go on for a while. " * 10
    rows = [(f"s/{k}", f"// SPDX-License-Identifier: {line}\n{prose}") for k, line in enumerate(SPDX)]
    for name, text in (("m", GRANT), ("b", BSD)):
        rows += [(f"{name}/1", text), (f"{name}/2", prose), (f"{name}1/1", " ".join(text.split())), (f"{name}1/2", prose)]
    rows += [("p/1", f"{prose}\n{LINES['MIT']}\n{prose}"), ("p/2", prose)]
    got = {r.path: (r.license, r.origin) for r in scan(spark.createDataFrame(rows, "p string, text string"), F.col("p"), ["p"]).collect()}
    assert [got[f"s/{k}"] for k in range(len(SPDX))] == [(x, "own") for x in SPDX.values()]
    for d, name in (("m", "MIT"), ("m1", "MIT"), ("b", "BSD-3-Clause"), ("b1", "BSD-3-Clause")):
        assert got[f"{d}/1"][0] == name and got[f"{d}/2"] == (got[f"{d}/1"][0], "inherited"), d
    assert got["p/1"] == ("MIT", "own") and got["p/2"] == (None, "none")
