"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

A file is scored in units of four levels: its lines, the sentences that are wrapped over
lines, its paragraphs (header blocks), and the whole file; copyright lines stand for themselves. Every
unit is a sparse vector of its words' counts times their inverse
document frequency. The frequencies of all words are counted over the lines of all
files, so those of a unit's words do not depend on the number of files of like
content. What a unit shares with the templates is known from their words alone; the
weights of its other words are joined to the few units that can reach SIMILAR. A unit is a
statement of the template that it is nearest to, if the cosine is SIMILAR or more; an SPDX
tag is one of the licence it names, with score 1. A file states the licence of the widest
unit of CLEAR or more, else of its best one; ties, to nine places, go to the first line and the template listed first.
A licence file, by its name or because most of its words are in statements of one level, also
speaks for its directory; a file without a statement inherits from the nearest
directory above it that has one, by joins on paths.

Defined results: a null or empty text states nothing but may inherit; a null path
inherits nothing; texts of any length are scanned whole; repeated rows get the same
row each; of several licence files in a directory the best score counts, then the
smallest licence name; an empty table gives an empty result; other columns are not
read. Of the long licences (Apache, GPL, LGPL, AGPL, MPL) the templates hold title and notice.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import checkpointed, ship

SIMILAR, CLEAR = 0.6, 0.9
#: Statements of well-known licences, as they stand in file headers and at the head of licence files.
STATEMENTS = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights: CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
)
#: Whole texts of short licences without their copyright lines, and titles and notices of long ones.
_WITHOUT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public License for more details."""
BODIES = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. " + _WITHOUT_WARRANTY),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _WITHOUT_WARRANTY),
    ("BSD-2-Clause", f"{_BSD}\n{_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD}\n{_BSD_THIRD}\n{_BSD_END}"),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-3.0", _GNU.format("", 3)),
    ("GPL-2.0", _GNU.format("", 2)),
    ("LGPL-3.0", _GNU.format("Lesser ", 3)),
    ("AGPL-3.0", _GNU.format("Affero ", 3)),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)
TEMPLATES = STATEMENTS + BODIES
#: Names of licence files.
FILE_NAME = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice|copyright)([.-][^/]*)?$"
#: Share of a file's words that must be in statements for it to be a licence file whatever its name.
LICENCE_SHARE = 0.5
#: An SPDX tag with a licence expression.
_TAG = re.compile(r"SPDX-License-Identifier:[ \t]*(\(?[A-Za-z0-9][A-Za-z0-9.+-]*\)?(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(?[A-Za-z0-9][A-Za-z0-9.+-]*\)?)*)", re.IGNORECASE)
_COPYRIGHT = re.compile(r"[^a-z0-9©]*(?:copyright\b|\(c\)|©|all rights reserved\W*$)", re.IGNORECASE)
_STOP = re.compile(r"[.:;](?=\s)")
LINE, SENTENCE, PARAGRAPH, WHOLE = range(4)
_WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def words_of(line: str) -> list[str]:
    return _WORD.findall(line.lower())


VOCABULARY = sorted({w for _, t in TEMPLATES for w in words_of(t)})
#: Distinct words that a task counts before it hands the counts on.
FLUSH = 200_000


def _counted(batches):
    """(word, lines with it) of all words, added up within a task; the empty word stands for the lines in all."""
    times: Counter[str] = Counter()

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(times.keys(), pa.string()), pa.array(times.values(), pa.int64())], names=["word", "times"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            for line in (text or "").split("\n"):
                words = set(words_of(line))
                if words:
                    times[""] += 1
                    times.update(words)
            if len(times) > FLUSH:
                yield rows()
                times.clear()
    yield rows()


class Templates:
    """Unit TF-IDF vectors of the templates, by word."""

    def __init__(self, lines: int, times: dict[str, int]):
        self.rare = float(np.log((lines + 1) / 1) + 1)  # the weight of an unseen word
        self.idf = {w: float(np.log((lines + 1) / (times.get(w, 0) + 1)) + 1) for w in VOCABULARY}
        self.by_word: dict[str, list[tuple[int, float]]] = {}
        for i, (_, text) in enumerate(TEMPLATES):
            weights = {w: n * self.idf[w] for w, n in Counter(words_of(text)).items()}
            norm = sum(x * x for x in weights.values()) ** 0.5
            for w, x in weights.items():
                self.by_word.setdefault(w, []).append((i, x / norm))

        # common words of which no template holds SIMILAR: a unit without another word of theirs can't be near any
        held = [0.0] * len(TEMPLATES)
        self.keys = set(VOCABULARY)
        for w in sorted(VOCABULARY, key=lambda w: (self.idf[w], w)):
            for i, y in self.by_word[w]:
                held[i] += y * y
            if max(held) >= SIMILAR**2 * (1 - 1e-9):
                break
            self.keys.discard(w)

    def square(self, counts: Counter[str]) -> float:
        """Square of the part of a line that is in template words."""
        return sum((counts[w] * self.idf[w]) ** 2 for w in sorted(counts.keys() & self.idf.keys()))

    def nearest(self, counts: Counter[str]) -> tuple[float, int]:
        """(dot product, template) of the nearest template; only templates that share a word are touched."""
        dots: dict[int, float] = {}
        for w, n in counts.items():
            for i, y in self.by_word.get(w, ()):
                dots[i] = dots.get(i, 0.0) + n * self.idf[w] * y
        if not dots:
            return 0.0, -1
        i = min(dots, key=lambda i: (-round(dots[i], 12), i))
        return dots[i], i

    def best(self, words: list[str]) -> tuple[float, int]:
        """(cosine, template) of the nearest template for a line whose other words are all unseen ones."""
        counts = Counter(words)
        dot, i = self.nearest(counts)
        others = sum((n * self.rare) ** 2 for w, n in counts.items() if w not in self.idf)
        return (min(1.0, dot / (self.square(counts) + others) ** 0.5), i) if dot else (0.0, -1)


def units(text: str) -> list[tuple[int, int, list[str]]]:
    """(level, first line, words) of the lines, wrapped sentences and paragraphs of a text and of the whole of it."""
    lines = text.split("\n")
    words = [words_of(x) for x in lines]
    out = [(LINE, k, ws) for k, ws in enumerate(words) if ws]
    apart = [bool(_COPYRIGHT.match(x)) for x in lines]
    start, parts = 0, 0
    for k in range(len(lines) + 1):
        if k < len(lines) and words[k] and not apart[k]:
            continue
        if k > start:
            parts += 1
        if k > start + 1:
            out.append((PARAGRAPH, start, [w for ws in words[start:k] for w in ws]))
            first, sentence = start, []
            for j in range(start, k):
                *ends, rest = _STOP.split(lines[j] + " ")
                for part in ends:
                    if j > first:
                        out.append((SENTENCE, first, sentence + words_of(part)))
                    first, sentence = j, []
                sentence = sentence + words_of(rest) if j > first else words_of(rest)
                if not sentence:
                    first = j + 1
            if sentence and k - 1 > first:
                out.append((SENTENCE, first, sentence))
        start = k + 1
    if parts > 1:
        out.append((WHOLE, 0, [w for ws, x in zip(words, apart) if not x for w in ws]))
    return out


def candidates(text: str | None, templates: Templates) -> tuple[int, list[dict]]:
    """(words in all, units that are statements unless their other words weigh too much). No word weighs less than 1, so no statement is left out."""
    found, text = [], text or ""
    for m in _TAG.finditer(text):
        line = text.count("\n", 0, m.start()) if not found else found[-1]["line"] + text.count("\n", at, m.start())
        at = m.start()
        found.append({"level": LINE, "line": line, "words": len(words_of(m[0])), "dot": 1.0, "square": 1.0, "license": m[1].strip(), "others": []})
    total = words_of(text)
    if templates.keys.isdisjoint(total):
        return len(total), found
    tagged = {x["line"] for x in found}
    for level, line, words in units(text):
        if templates.keys.isdisjoint(words) or (level == LINE and line in tagged):
            continue
        counts = Counter(words)
        square = templates.square(counts)
        others = {w: n for w, n in counts.items() if w not in templates.idf}
        least = (square + sum(n * n for n in others.values())) ** 0.5 * SIMILAR * (1 - 1e-9)
        if square**0.5 < least:
            continue
        dot, i = templates.nearest(counts)
        if dot >= least:
            found.append({"level": level, "line": line, "words": len(words), "dot": dot, "square": square, "license": TEMPLATES[i][0], "others": [{"word": w, "n": n} for w, n in others.items()]})
    return len(total), found


def scan_licenses(files: DataFrame, key_cols: list[str], path_col: str = "path", text_col: str = "text") -> DataFrame:
    """(key columns, path, license, score, origin: header, file, inherited or null, n_statements) of every row."""
    ship(files.sparkSession)
    counted = checkpointed(files.select(F.col(text_col).cast("string")).mapInArrow(_counted, "word string, times bigint").groupBy("word").agg(F.sum("times").alias("times")))
    times = {r.word: r.times for r in counted.filter(F.col("word").isin("", *VOCABULARY)).collect()}  # a row for each template word
    n_lines = times.pop("", 0)
    templates = Templates(n_lines, times)
    n = len(key_cols)
    line_type = pa.list_(pa.struct([("level", pa.int64()), ("line", pa.int64()), ("words", pa.int64()), ("dot", pa.float64()), ("square", pa.float64()), ("license", pa.string()), ("others", pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())])))]))

    def scan(batches):
        for batch in batches:
            got = [candidates(text, templates) for text in batch.column(n + 2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: n + 2], pa.array([x[0] for x in got], pa.int64()), pa.array([x[1] for x in got], line_type)], names=[*names, "total", "lines"])

    names = [*(f"k{i}" for i in range(n)), "path", "row"]
    picked = files.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(key_cols)), F.col(path_col).alias("path"), F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").alias("text"))
    kinds = ", ".join(f"k{i} {files.schema[c].dataType.simpleString()}" for i, c in enumerate(key_cols))
    line_kind = "array<struct<level:bigint,line:bigint,words:bigint,dot:double,square:double,license:string,others:array<struct<word:string,n:bigint>>>>"
    scanned = checkpointed(picked.mapInArrow(scan, f"{kinds}, path string, row bigint, total bigint, lines {line_kind}"))

    near = scanned.select("row", F.explode("lines").alias("x")).select("row", "x.*")
    weight = F.col("o.n") * (F.log(F.lit(n_lines + 1.0) / (F.col("times") + 1)) + 1)
    weighed = near.select("row", "level", "line", F.explode("others").alias("o")).join(counted, F.col("o.word") == F.col("word")).groupBy("row", "level", "line").agg(F.sort_array(F.collect_list(weight * weight)).alias("parts"))  # in order, so that sums are the same in every run
    other = F.coalesce(F.aggregate("parts", F.lit(0.0), lambda x, y: x + y), F.lit(0.0))
    stated = near.join(weighed, ["row", "level", "line"], "left").withColumn("score", F.round(F.least(F.lit(1.0), F.col("dot") / F.sqrt(F.col("square") + other)), 9)).filter(F.col("score") >= SIMILAR)
    rank = F.struct(F.when(F.col("score") >= CLEAR, F.col("level")).otherwise(-1).alias("wide"), "score", (-F.col("line")).alias("l"), "license")
    levels = stated.groupBy("row", "level").agg(F.max(rank).alias("x"), F.sum("words").alias("inside"), F.count("*").alias("n"))
    best = levels.groupBy("row").agg(F.max("x").alias("x"), F.max("inside").alias("inside"), F.max("n").alias("n"))
    whole = F.coalesce(F.col("inside") >= LICENCE_SHARE * F.col("total"), F.lit(False))
    own = checkpointed(scanned.drop("lines").join(best, "row", "left").select(*names[:-1], "x.license", "x.score", whole.alias("whole"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_statements")))

    is_file = F.coalesce(F.col("path").rlike(FILE_NAME) | F.col("whole"), F.col("whole"))
    folder = F.regexp_replace("path", r"/?[^/]*$", "")
    speaking = own.filter(F.col("license").isNotNull() & F.col("path").isNotNull() & is_file).groupBy(folder.alias("folder")).agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("x")).select("folder", F.col("x.license").alias("folder_license"), (-F.col("x.s")).alias("folder_score"))
    # folders, not files, look up their ancestors
    steps = F.split("folder", "/")
    folders = own.filter("license IS NULL AND path IS NOT NULL").select(folder.alias("folder")).distinct()
    above = folders.select("folder", F.explode(F.transform(F.sequence(F.lit(0), F.size(steps)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(steps, 1, i), "/").alias("ancestor")))).alias("x")).select("folder", "x.depth", "x.ancestor")
    nearest = above.join(speaking.withColumnRenamed("folder", "ancestor"), "ancestor").groupBy("folder").agg(F.max(F.struct("depth", "folder_license", "folder_score")).alias("x")).select("folder", F.col("x.folder_license").alias("up_license"), F.col("x.folder_score").alias("up_score"))
    joined = own.withColumn("folder", F.when(F.col("license").isNull(), folder)).join(nearest, "folder", "left")
    origin = F.when(F.col("license").isNotNull(), F.when(is_file, "file").otherwise("header")).when(F.col("up_license").isNotNull(), "inherited")
    return joined.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(key_cols)), "path", F.coalesce("license", "up_license").alias("license"), F.coalesce("score", "up_score").alias("score"), origin.alias("origin"), "n_statements")
