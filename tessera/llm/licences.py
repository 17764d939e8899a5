"""Licence scans: TF-IDF cosines of passages to templates, then inheritance from the nearest directory.

Templates are the wording of licence headers, notices and files. For each template every
passage of its own length (the whole text, where that is shorter) is a sparse TF-IDF vector
and is compared with the template's; so a header is found in a line of its own, within a
paragraph or in a text without line breaks, and a licence file as a whole. Inverse document
frequencies are those of all texts. A text has the licence of its passage that is most like
a template, if that is like enough. The first text of a directory that has one is that
directory's licence file; texts without one of their own take that of the nearest directory
above them which has one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, checkpointed

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES
OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form
must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""
_BSD_NAMES = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE."""
_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation,
either version {} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {} for more details."""


def _gpl(name: str, version: str) -> str:
    return _GPL.format(name, version, name)


# Names of licences and the wording of their headers, notices and files.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", """Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("MIT", "Released under the MIT License"),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"),
to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. """ + _WARRANTY),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""),
    ("BSD-2-Clause", f"{_BSD} {_BSD_WARRANTY}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_NAMES} {_BSD_WARRANTY}"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", _BSD_NAMES),
    ("GPL-2.0", _gpl("General Public License", "2")),
    ("GPL-3.0", _gpl("General Public License", "3")),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", _gpl("Lesser General Public License", "3")),
    ("AGPL-3.0", _gpl("Affero General Public License", "3")),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file,
You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    *[(n, f"SPDX-License-Identifier: {n}") for n in ("Apache-2.0", "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "CC-BY-4.0", "CC-BY-NC-4.0", "Unlicense")],
)

THRESHOLD = 0.75
#: Passages of a text that are measured one by one; more of them are measured together, with the same result.
FEW = 256

WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Templates:
    """The templates' TF-IDF vectors of length one. df and n: in how many of n texts a word is.

    Words that are in no template have the mean inverse document frequency of those that are.
    """

    def __init__(self, templates: Sequence[tuple[str, str]] = TEMPLATES, df: Mapping[str, int] | None = None, n: int = 0, threshold: float = THRESHOLD):
        self.names, self.threshold = [x for x, _ in templates], threshold
        bags = [Counter(words_of(t)) for _, t in templates]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for b in bags for w in b}))}
        size = len(self.vocabulary)
        self.idf = np.array([math.log((1 + n) / (1 + (df or {}).get(w, 0))) + 1 for w in self.vocabulary])
        self.unknown = float(self.idf.mean()) if size else 1.0
        self.lengths = [sum(b.values()) for b in bags]
        self.vectors = np.zeros((len(bags), size))
        for i, b in enumerate(bags):
            for w, c in b.items():
                self.vectors[i, self.vocabulary[w]] = c * self.idf[self.vocabulary[w]]
            self.vectors[i] /= max(1e-12, np.linalg.norm(self.vectors[i]))
        # A passage as like as the threshold has one at least of these words, as the others' weight falls short of it.
        self.telling: dict[str, list[int]] = {}
        words = list(self.vocabulary)
        for i, v in enumerate(self.vectors):
            order = np.argsort(-v, kind="stable")
            left = 1 - np.cumsum(v[order] ** 2)
            for j in order[: int(np.argmax(left < (threshold - 1e-6) ** 2)) + 1]:
                self.telling.setdefault(words[j], []).append(i)

    def best(self, text: str) -> tuple[str | None, float | None, int | None]:
        """Licence, cosine (to 6 places) and line number of the passage most like a template, if any reaches the threshold.

        Of equal cosines the earliest passage wins, then the template that stands first.
        """
        words = words_of(text)
        told = self.telling.keys() & set(words)
        if not told:
            return None, None, None
        size, own = len(self.vocabulary), {}
        ids = np.array([self.vocabulary[w] if w in self.vocabulary else own.setdefault(w, size + len(own)) for w in words])
        idf = np.where(ids < size, self.idf[np.minimum(ids, size - 1)], self.unknown)
        found = None
        for t in sorted({t for w in told for t in self.telling[w]}):
            cosines, starts = self._cosines(ids, idf, t)
            if len(cosines) and (top := cosines.max()) >= self.threshold:
                at = int(starts[cosines == top].min())
                if found is None or (-top, at) < found[:2]:
                    found = (-top, at, t)
        if found is None:
            return None, None, None
        start = next(m.start() for i, m in enumerate(WORD.finditer(text.lower())) if i == found[1])
        return self.names[found[2]], float(-found[0]), text.lower().count("\n", 0, start)

    def _cosines(self, ids: np.ndarray, idf: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Cosines and starts of the passages that may reach the threshold."""
        size, length = len(self.vocabulary), min(self.lengths[t], len(ids))
        known = np.append(self.vectors[t], 0.0)[np.minimum(ids, size)]
        run = lambda x: (c := np.concatenate([[0.0], np.cumsum(x)]))[length:] - c[:-length]
        dots, squares = run(idf * known), run(idf * idf)
        # Repeated words only make the vector longer, so this is no less than the cosine.
        starts = np.flatnonzero(dots >= (self.threshold - 1e-6) * np.sqrt(squares))
        if len(starts) <= FEW:
            out = []
            for s in starts.tolist():
                u, first, c = np.unique(ids[s : s + length], return_index=True, return_counts=True)
                weight = c * idf[s : s + length][first]
                out.append(float(weight @ np.append(self.vectors[t], 0.0)[np.minimum(u, size)]) / math.sqrt(float(weight @ weight)))
            return np.round(np.array(out), 6), starts
        # A word that stands twice in a passage, at places i < j, adds twice its square to the sum of squares.
        grown = np.zeros(len(ids) + 1)
        for gap in range(1, length):
            i = np.flatnonzero(ids[:-gap] == ids[gap:])
            np.add.at(grown, np.maximum(0, i + gap - length + 1), 2 * idf[i] ** 2)
            np.add.at(grown, i + 1, -2 * idf[i] ** 2)
        squares = squares + np.cumsum(grown)[: len(squares)]
        return np.round(dots[starts] / np.sqrt(squares[starts]), 6), starts


def frequencies(docs: DataFrame, text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES) -> tuple[dict[str, int], int]:
    """In how many of all texts each word of the templates is, and the number of texts.

    The driver gets a row for each word of the templates.
    """
    bounded_batches(docs.sparkSession)
    vocabulary = sorted({w for _, t in templates for w in words_of(t)})

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known, counts, n = set(vocabulary), Counter(), 0
        for batch in batches:
            n += batch.num_rows
            for t in batch.column(0):
                counts.update(known.intersection(words_of(t.as_py())))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(["", *counts], pa.string()), pa.array([n, *counts.values()], pa.int64())], names=["word", "n"])

    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("t")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r.word: r.n for r in rows.collect()}
    return found, found.pop("", 0)


def scan(docs: DataFrame, path: str = "path", key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
         templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Each text's own licence, by its whole text: key, path, own string, cosine double, line long.

    own, cosine and line are null where no passage reaches the threshold.
    """
    df, n = frequencies(docs, text, templates)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = Templates(templates, df, n, threshold)
        for batch in batches:
            got = [known.best(t.as_py()) for t in batch.column(2)]
            columns = [pa.array([g[i] for g in got], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["k", "path", "own", "cosine", "line"])

    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(path).cast("string").alias("path"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return rows.mapInArrow(run, "k long, path string, own string, cosine double, line long").withColumnRenamed("k", key)


def directory(path: Column) -> Column:
    """What stands before the last slash; empty for a path without one."""
    return F.coalesce(F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1), F.lit(""))


def inherited(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Adds the nearest ancestor directory with a licence: licence, inherited_from string.

    The licence of a directory is that of its text with the smallest path (then key) among
    those with one of their own. The directory with the empty name is above all others.
    Ancestors are joined to the distinct directories, not to the texts, so that a directory
    that holds a third of all rows is one row there.
    """
    # Written once: the texts are scanned once for the files, the directories and the result.
    rows = checkpointed(scanned.withColumn("dir", directory(F.col("path"))))
    files = rows.where("own IS NOT NULL").groupBy("dir").agg(F.min(F.struct("path", F.col(key).alias("k"), "own")).alias("m"))
    files = files.select(F.col("dir").alias("up"), F.col("m.own").alias("licence"))
    dirs = rows.select("dir").distinct().withColumn("parts", F.split("dir", "/"))
    above = dirs.select("dir", F.explode(F.sequence(F.lit(0), F.size("parts"))).alias("depth"), "parts")
    above = above.select("dir", "depth", F.array_join(F.slice("parts", F.lit(1), F.col("depth")), "/").alias("up"))
    near = above.join(files, "up").groupBy("dir").agg(F.max(F.struct("depth", "up", "licence")).alias("m"))
    near = near.select("dir", F.col("m.up").alias("up"), F.col("m.licence").alias("above"))
    # Written before it is joined, so that the part of a directory with very many texts can be split.
    out = rows.join(checkpointed(near), "dir", "left")
    return out.select(
        key, "path", "own", "cosine", "line",
        F.coalesce("own", "above").alias("licence"),
        F.when(F.col("own").isNull(), F.col("up")).alias("inherited_from"),
    )


def licences(docs: DataFrame, path: str = "path", key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """key, path, own, cosine, line, licence, inherited_from for each row.

    Null texts count as empty (no licence of their own). Null paths lie in the directory
    with the empty name, as do paths without a slash; all texts inherit its licence. Repeated rows and null keys
    give a row each, an empty table an empty one; other columns aren't read.
    """
    return inherited(scan(docs, path, key, text, **settings), key)


def corpus_path() -> Column:
    """A path for the rows of documents, which have none: source, language and ranges of ids as directories.

    A file lies one to four directories deep, by the crc32 of its id.
    """
    number = F.coalesce(F.col("doc_id"), F.lit(-1))
    name = lambda c: F.coalesce(F.col(c), F.lit("none"))
    dirs = F.array(name("source"), name("lang"), F.floor(number / 1000).cast("string"), F.floor(number / 100).cast("string"))
    depth = (F.crc32(number.cast("string")) % 4 + 1).cast("int")
    return F.concat(F.array_join(F.slice(dirs, F.lit(1), depth), "/"), F.lit("/"), number.cast("string"), F.lit(".txt"))
