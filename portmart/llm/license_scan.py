"""License scan: sparse TF-IDF cosine to templates, then inheritance from ancestor directories.

1. The vocabulary is the templates' words. One pass counts in how many documents each of them
   occurs (numbers for some thousand words; they are summed before the shuffle).
2. Candidates are the whole text, comment blocks, paragraphs and single lines, the larger ones
   first: what lies within a match is not looked at again, unless only the family is known. A
   candidate's TF-IDF vector is compared with each template's by cosine; words outside the
   vocabulary count with the largest idf, so text that only mentions a license stays dissimilar.
   Whole texts and blocks also meet the full licence texts. A candidate without any anchor word
   of a template can't reach MIN_COSINE (the template's other words have too little weight, by
   Cauchy-Schwarz), so only those with one are scored; nothing else is left out. A template
   holds only where its names, versions and CC terms stand too (``identity``), so another
   version gets its own template or the family (``GPL``, ``Apache``, ...), not a near miss.
3. A document's own license is its best candidate's, names with a version before families. A file
   named like a licence file, or one whose text is little else than the license, speaks for its
   directory.
4. Files without a license of their own inherit from the nearest ancestor directory that has one:
   (file, ancestor) pairs, one per directory level, are joined to the directories and the deepest
   match wins. Directories are narrow rows, one each, so a directory with a third of all files
   is joined per distinct directory first and files only look up their own directory.

Defined cases: null text has no lines, null paths no directory and no inheritance; ties go to the
first template, in a directory to the best cosine and then the smallest license name; repeated
rows are judged alike; empty tables give empty tables; extra columns stay out.
"""

from __future__ import annotations

import math
import pkgutil
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_0BSD = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC = _0BSD + ", provided that the above copyright notice and this permission notice appear in all copies."
_AS_IS = """ THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are
met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution. """
_BSD_AD = """All advertising materials mentioning features or use of this software must display the following acknowledgement: This product
includes software developed by the organization. """
_BSD_NAME = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission. """
_BSD_AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED
TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
# Usual statements, headings and header paragraphs of public licenses.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    # headings; a name without a version is the family
    ("Apache", "Apache License"),
    ("Apache", "Licensed under the Apache License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("GPL", "GNU GENERAL PUBLIC LICENSE"),
    ("GPL", "This work is licensed under the GNU General Public License."),
    ("GPL", "it under the terms of the GNU General Public License as published by"),
    ("LGPL", "GNU LESSER GENERAL PUBLIC LICENSE"),
    ("LGPL", "it under the terms of the GNU Lesser General Public License as published by"),
    ("AGPL", "GNU AFFERO GENERAL PUBLIC LICENSE"),
    ("AGPL", "it under the terms of the GNU Affero General Public License as published by"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "BSD License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("ISC", "ISC License"),
    ("ISC", "Released under the ISC License."),
    ("MPL", "Mozilla Public License"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    *((n, "SPDX-License-Identifier: " + n + tail) for n in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for tail in ("", "-only", "-or-later")),
    *((n, "SPDX-License-Identifier: " + n) for n in ("BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "0BSD", "CC0-1.0")),
    *((f"CC-{t}-4.0", line.format(t, w)) for t, w in (
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
        ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
      for line in ("Licensed under CC {0} 4.0.", "SPDX-License-Identifier: CC-{0}-4.0", "Creative Commons {1} 4.0 International Public License",
                   "This work is licensed under a Creative Commons {1} 4.0 International License.")),
    # header paragraphs, and first lines that stand alone where they are wrapped
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
        You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License");"""),
    *((n, f"""This program is free software; you can redistribute it and/or modify it under the terms of the GNU {w}General Public License as
        published by the Free Software Foundation; either version {v} of the License, or (at your option) any later version.""")
      for n, w, v in (("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3"))),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
        with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("MIT", _MIT.split("\n\n")[0]),
    ("ISC", _ISC),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD", "Redistribution and use in source and binary forms, with or without"),
)
FAMILIES = {"Apache", "GPL", "LGPL", "AGPL", "BSD", "MPL"}
MIN_COSINE = 0.7
FILE_SHARE = 0.5  # a licence file: this share of its words is in license text
TITLE = 40  # words that name a whole licence, from the first name on, wherever that stands
_WORD = re.compile(r"[a-z0-9.+]*[a-z0-9+]")
FILE_NAMES = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"


def tokens(line: str) -> list[str]:
    return _WORD.findall(line.lower())


def full_templates() -> tuple[tuple[str, str], ...]:
    """Whole licence texts. The AGPL's is the GPL's under its own name (some paragraphs differ)."""
    files = ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0")
    texts = {n: (pkgutil.get_data("portmart.llm", f"licenses/{n}.txt") or b"").decode() for n in files}
    texts["AGPL-3.0"] = texts["GPL-3.0"].replace("GNU GENERAL", "GNU AFFERO GENERAL").replace("GNU General", "GNU Affero General")
    return (*texts.items(), ("MIT", _MIT), ("ISC", _ISC + _AS_IS), ("0BSD", _0BSD + "." + _AS_IS), ("BSD-2-Clause", _BSD + _BSD_AS_IS),
            ("BSD-3-Clause", _BSD + "3. " + _BSD_NAME + _BSD_AS_IS), ("BSD-4-Clause", _BSD + "3. " + _BSD_AD + "4. " + _BSD_NAME + _BSD_AS_IS))


_NAMES = {"mit": "mit", "apache": "apache", "gpl": "gpl", "lgpl": "lgpl", "lesser": "lgpl", "library": "lgpl", "agpl": "agpl", "affero": "agpl",
          "bsd": "bsd", "0bsd": "0bsd", "mpl": "mpl", "mozilla": "mpl", "isc": "isc", "cc": "cc", "cc0": "cc0", "commons": "cc"}
_TERMS = {"nc": "nc", "noncommercial": "nc", "sa": "sa", "sharealike": "sa", "nd": "nd", "noderivatives": "nd", "noderivs": "nd"}
_VERSION = re.compile(r"v?(\d{1,2}(?:\.\d{1,2})*)\+?")
_BEFORE_VERSION = {"version", "v", "license", "licence", "by", "international", "attribution", *_NAMES, *_TERMS}


def identity(words: list[str]) -> tuple[frozenset, frozenset, frozenset]:
    """(names, versions, CC terms) that stand in ``words``; 2 and 2.0 are one version."""
    names = {_NAMES[w] for w in words if w in _NAMES}
    if "general" in words and "public" in words and not names & {"lgpl", "agpl"}:
        names.add("gpl")
    if names & {"lgpl", "agpl"}:
        names.discard("gpl")
    versions = set()
    for before, w, after in zip(["", *words], words, [*words[1:], ""]):
        if w[-1:].isdigit() or w[-1:] == "+":
            m = _VERSION.fullmatch(w)
            if m and (before in _BEFORE_VERSION or after == "clause"):
                versions.add(re.sub(r"(\.0)+$", "", m[1]))
    return frozenset(names), frozenset(versions), frozenset(_TERMS[w] for w in words if w in _TERMS) if "cc" in names else frozenset()


def title(words: list[str]) -> list[str]:
    """The TITLE words from the first that names a licence on, none if no word does. What stands before, such as
    copyright lines of any number, plays no part."""
    for i, w in enumerate(words):
        if w in _NAMES or (w == "general" and words[i + 1:i + 2] == ["public"]):
            return words[max(0, i - 1):i + TITLE]
    return []


class Matcher:
    """Templates as TF-IDF vectors under the document counts ``df`` of ``n`` documents; ``full`` are
    whole licences."""

    def __init__(self, templates, df: dict[str, int], n: int, full=()):
        every = [(name, tokens(t)) for name, t in (*templates, *full)]
        self.idf = {w: math.log((1 + n) / (1 + df.get(w, 0))) + 1 for _, t in every for w in t}
        self.other = math.log(1 + n) + 1
        self.short = len(templates)
        self.names, self.identities, self.index = [name for name, _ in every], [], {}
        anchors: tuple[set, set] = set(), set()
        for k, (_, words) in enumerate(every):
            self.identities.append(identity(words if k < self.short else title(words)))
            vector = {w: c * self.idf[w] for w, c in Counter(words).items()}
            norm = math.sqrt(sum(v * v for v in vector.values()))
            for w, v in vector.items():
                self.index.setdefault(w, []).append((k, v / norm))
            rest = 1.0
            for w, v in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
                if math.sqrt(max(rest, 0.0)) < MIN_COSINE * 0.999:
                    break
                anchors[k >= self.short].add(w)
                rest -= (v / norm) ** 2
        self.anchors, self.all_anchors = anchors[0], anchors[0] | anchors[1]

    def holds(self, k: int, mine, head) -> bool:
        """Do template ``k``'s names, versions and terms stand in a candidate?"""
        names, versions, terms = self.identities[k]
        if k < self.short:
            return names <= mine[0] and versions <= mine[1] and terms == mine[2]
        return (not names or not head[0] or names <= head[0]) and (not versions or not head[1] or bool(versions & head[1]))

    def score(self, words: list[str], full: bool = False) -> tuple[float, str | None]:
        """(best cosine, license); a license with its version goes before a family."""
        counts = Counter(words)
        total = inside = 0.0
        known = []
        for w, c in counts.items():
            idf = self.idf.get(w)
            v = c * (self.other if idf is None else idf)
            total += v * v
            if idf is not None:
                inside += v * v
                known.append((w, v))
        if not known or inside < (MIN_COSINE * 0.999) ** 2 * total:  # no cosine is above the known words' share
            return (math.sqrt(inside / total) if total else 0.0), None
        dots = [0.0] * (len(self.names) if full else self.short)
        for w, v in known:
            for k, t in self.index[w]:
                if k >= len(dots):
                    break
                dots[k] += t * v
        norm = math.sqrt(total)
        near = [k for k, d in enumerate(dots) if d >= MIN_COSINE * norm]
        if not near:
            return max(dots) / norm, None
        mine, head = identity(words), identity(title(words))
        near = [k for k in near if self.holds(k, mine, head)]
        if not near:
            return max(dots) / norm, None
        top = max(near, key=lambda k: (self.names[k] not in FAMILIES, round(dots[k] / norm, 12), -k))
        return dots[top] / norm, self.names[top]

    def best(self, line: str) -> tuple[float, str | None]:
        return self.score(tokens(line))

    def scan(self, text: str) -> tuple[str | None, float, bool]:
        """(license, cosine, is the text little else than licenses) of a whole text."""
        words = tokens(text)
        if self.all_anchors.isdisjoint(words):
            return None, 0.0, False
        found: list[tuple[bool, float, str]] = []
        covered = 0
        cosine, name = self.score(words, full=True)
        if name:
            found.append((name not in FAMILIES, cosine, name))
            covered = len(words)
        if not (name and name not in FAMILIES):
            lines = [tokens(line) for line in text.split("\n")]
            done = [False] * len(lines)
            counted = [bool(name)] * len(lines)
            for full, parts in ((True, _comments(text)), (True, _paragraphs(text, lines)), (False, ((i, i + 1) for i in range(len(lines))))):
                for a, b in parts:
                    part = [w for line in lines[a:b] for w in line]
                    if all(done[a:b]) or (self.all_anchors if full else self.anchors).isdisjoint(part):
                        continue
                    cosine, name = self.score(part, full)
                    if name:
                        found.append((name not in FAMILIES, cosine, name))
                        covered += sum(len(lines[i]) for i in range(a, b) if not counted[i])
                        counted[a:b] = [True] * (b - a)
                        if name not in FAMILIES:
                            done[a:b] = [True] * (b - a)
        if not found:
            return None, 0.0, False
        _, cosine, name = max(found, key=lambda f: (f[0], round(f[1], 12)))
        return name, cosine, covered >= FILE_SHARE * len(words)

    def lines(self, text: str) -> Iterator[str]:
        """The lines with an anchor word."""
        return (line for line in text.split("\n") if not self.anchors.isdisjoint(tokens(line)))


_COMMENT = re.compile(r"\s*(#|//|/\*|\*|--|;|%|<!--|\.\.|')")


def _commented(text: str) -> list[bool]:
    out, inside = [], False
    for line in text.split("\n"):
        out.append(inside or _COMMENT.match(line) is not None)
        at, end = line.rfind("/*"), line.rfind("*/")
        inside = at > end or (inside and end < 0)
    return out


def _comments(text: str) -> Iterator[tuple[int, int]]:
    """Runs of more than one comment line."""
    flags, a = [*_commented(text), False], 0
    for i, flag in enumerate(flags):
        if not flag:
            if i - a > 1:
                yield a, i
            a = i + 1


def _paragraphs(text: str, lines: list[list[str]]) -> Iterator[tuple[int, int]]:
    """Runs of more than one line with words, all of them comments or none."""
    flags, a = _commented(text), 0
    for i in range(len(lines) + 1):
        if i == len(lines) or not lines[i] or (i > a and flags[i] != flags[i - 1]):
            if i - a > 1:
                yield a, i
            a = i if i < len(lines) and lines[i] else i + 1


def word_counts(df: DataFrame, text_col: str, words: list[str]) -> tuple[dict[str, int], int]:
    """In how many texts each of ``words`` occurs, over all rows, and the number of rows."""
    listed = sorted(set(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, counts, n = set(listed), Counter(), 0
        # runs of the token alphabet; only those are ever tokens
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(wanted.intersection(_WORD.findall((text or "").lower())))
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([*counts, ""], pa.string()), pa.array([*counts.values(), n], pa.int64())], names=["w", "n"])
    rows = df.select(F.col(text_col).cast("string")).mapInArrow(run, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()
    found = {r["w"]: int(r["n"]) for r in rows}  # one row per vocabulary word
    return found, found.pop("", 0)


def scan_texts(df: DataFrame, id_col: str, text_col: str, path_col: str, templates=TEMPLATES, full=None) -> DataFrame:
    """``(id, path, own, cosine, is_file)``: each text's own license."""
    full = full_templates() if full is None else full
    counts, n = word_counts(df, text_col, [w for _, t in (*templates, *full) for w in tokens(t)])
    shared = df.sparkSession.sparkContext.broadcast(Matcher(templates, counts, n, full))
    kind = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shared.value.scan(t or "") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([g[0] for g in got], pa.string()),
                                              pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.bool_())],
                                             names=[id_col, "path", "own", "cosine", "is_file"])
    rows = df.select(id_col, F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("_t"))
    found = rows.mapInArrow(run, f"`{id_col}` {kind}, path string, own string, cosine double, is_file boolean")
    named = F.element_at(F.split("path", "/"), -1).rlike(FILE_NAMES)
    return found.withColumn("is_file", F.col("own").isNotNull() & (F.col("is_file") | F.coalesce(named, F.lit(False))))


def _parent(path: str) -> "F.Column":
    return F.when(F.instr(path, "/") > 0, F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)).when(F.col(path).isNotNull(), F.lit(""))


def inherit(scanned: DataFrame, id_col: str) -> DataFrame:
    """``scanned`` with ``license`` (own, else the nearest ancestor directory's), ``via`` (own,
    inherited or none) and ``from_dir``. ``scanned`` should be a written table; it is read thrice."""
    rows = scanned.withColumn("_dir", _parent("path"))
    best = F.struct((-F.round("cosine", 9)).alias("c"), F.col("own").alias("license"))
    spoken = rows.filter("is_file and _dir is not null").groupBy("_dir").agg(F.min(best).alias("_b")).select(
        F.col("_dir").alias("anc"), F.col("_b.license").alias("_license"))
    # every directory with files, and each of its ancestors up to the root ""
    parts = F.split("_dir", "/")
    dirs = rows.select("_dir").filter("_dir is not null").distinct()
    levels = dirs.select("_dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth")).select(
        "_dir", "depth", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/").alias("anc")).distinct()
    nearest = levels.join(spoken, "anc").groupBy("_dir").agg(F.max(F.struct("depth", "anc", "_license")).alias("_near")).select(
        "_dir", F.col("_near.anc").alias("_anc"), F.col("_near._license").alias("_inherited"))
    out = rows.join(nearest, "_dir", "left")
    own = F.col("own").isNotNull()
    return out.select(id_col, "path", F.coalesce("own", "_inherited").alias("license"),
                      F.when(own, "own").when(F.col("_inherited").isNotNull(), "inherited").otherwise("none").alias("via"),
                      F.when(~own, F.col("_anc")).alias("from_dir"), "cosine", "is_file")
