"""License scans by conditional compression.

Candidate blocks (sentences or lines with a licensing word or a part of a confirmed statement, joined where they follow each other) are compressed alone and with each
template as zstandard raw dictionary. The template that saves most is the block's likeliest; it is confirmed by the wording
itself: the words of one of the template's statements that the block lacks, in order, and what it has in their place.
The templates after it are tried too, on the words that no confirmed one has taken, so a near name doesn't hide the right one and a
block with several licenses gives them all.
"""

from __future__ import annotations

import bisect
import difflib
import functools
import math
import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The disclaimer that several short licenses share (fixed value).
_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES "
    "OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_TWO = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce "
    "the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_THREE = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."


def _free_software(kind: str, version: str) -> str:
    return f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."


#: License -> its statements (fixed values: names, notices and, where they are short, whole texts of public licenses).
TEMPLATES: Mapping[str, Sequence[str]] = {
    "AGPL-3.0": ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3.", _free_software("Affero General Public License", "3")),
    "Apache-2.0": (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "BSD-2-Clause": ("BSD-2-Clause", "Released under the BSD 2-Clause License.", f"{_BSD} {_BSD_TWO} {_AS_IS}"),
    "BSD-3-Clause": ("BSD-3-Clause", _BSD, "Released under the BSD 3-Clause License.", f"{_BSD} {_BSD_TWO} {_BSD_THREE} {_AS_IS}"),
    "CC-BY-4.0": ("CC-BY-4.0", "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-ND-4.0": ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "CC-BY-SA-4.0": ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    "GPL-2.0": ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", _free_software("General Public License", "2")),
    "GPL-3.0": ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", _free_software("General Public License", "3")),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    "LGPL-3.0": ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3.", _free_software("Lesser General Public License", "3")),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "MPL-2.0": ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
}
#: Between the words of a signal: blanks, or a line's end and what opens the next line of a comment.
_GAP = r"(?:[ \t]+|[ \t]*\r?\n[^A-Za-z0-9\n]*)"
#: What makes a sentence or line a candidate; in both Java's and Python's notation.
SIGNAL = r"(?i:licen[cs]e|copyright|permission is hereby|permission to use|redistribution and use|public domain|creative commons|\bcc[ -]by\b|\bcc0\b|\b[al]?gpl-\d|\bmpl-\d|\bapache-\d|\bbsd-\d|\bfree software\b)".replace("[ -]", "\0").replace(" ", _GAP).replace("\0", f"(?:-|{_GAP})")
#: A statement is confirmed if at most this share of its words is missing or replaced, and no number or kind of license is.
MISSING = 0.2
#: Words that may not differ (fixed values), besides numbers.
TELLING = frozenset("affero agpl apache attribution bsd by cc cc0 endorse gnu gpl isc lesser lgpl mit mozilla mpl nc nd noderivatives noncommercial sa sharealike".split())
_LOWER = {i: i + 32 for i in range(65, 91)}  # keeps every character's place
_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_PART = re.compile(r"[^\n.!?]*(?:[.!?](?!\s)[^\n.!?]*)*(?:[.!?]+|\n|$)")


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Their union, in order."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = out[-1][0], max(stop, out[-1][1])
        else:
            out.append((start, stop))
    return out


def candidate_blocks(text: str, also: Sequence[tuple[int, int]] = ()) -> Iterator[tuple[int, str]]:
    """(start, text) of maximal runs of sentences or lines with a signal or with a part of one of the spans ``also``."""
    marks = _joined([m.span() for m in re.finditer(SIGNAL, text)] + list(also))
    start, stop, k = -1, -1, 0
    for m in _PART.finditer(text):
        if m.end() == m.start():
            continue
        while k < len(marks) and marks[k][1] <= m.start():
            k += 1
        if k < len(marks) and marks[k][0] < m.end():
            if m.start() == stop or start >= 0 and not text[stop : m.start()].strip():
                stop = m.end()
            else:
                if start >= 0:
                    yield start, text[start:stop]
                start, stop = m.start(), m.end()
    if start >= 0:
        yield start, text[start:stop]


@functools.lru_cache(4)
def _compressors(templates: tuple[tuple[str, tuple[str, ...]], ...]):
    import zstandard as z

    plain = z.ZstdCompressor(level=3, write_checksum=False, write_content_size=False)
    return plain, [(name, z.ZstdCompressor(level=3, write_checksum=False, write_content_size=False, write_dict_id=False, dict_data=z.ZstdCompressionDict("\n".join(s).encode(), dict_type=z.DICT_TYPE_RAWCONTENT))) for name, s in templates]


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@functools.lru_cache(1000)
def statement_words(statement: str) -> tuple[str, ...]:
    return tuple(words(statement))


def differences(statement: str, block: str) -> tuple[list[str], list[str]]:
    """(words of the statement that the block lacks, words that the block has in their places)."""
    a, b = words(statement), words(block)
    lacks, has = [], []
    for tag, i, j, k, m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if tag in ("replace", "delete"):
            lacks += a[i:j]
        if tag in ("replace", "insert") and 0 < i < len(a):  # before and after the statement anything may stand
            has += b[k:m]
    return lacks, has


def tells(word: str) -> bool:
    return word in TELLING or word[0].isdigit()


def confirmed(statement: str, lacks: list[str], has: list[str]) -> bool:
    most = MISSING * len(statement_words(statement))
    return len(lacks) <= most and len(has) <= most and not any(map(tells, lacks)) and not any(map(tells, has))


def possible(statement: Sequence[str], there: set[str]) -> bool:
    """Whether a text of these words can confirm the statement at all."""
    absent = [w for w in statement if w not in there]
    return len(absent) <= MISSING * len(statement) and not any(map(tells, absent))


def places(statement: str, text: list[str]) -> Iterator[tuple[int, int, list[str], list[str]]]:
    """(first word, end, missing words, other words) of the places in ``text`` that confirm the statement; none overlap.

    Column by column, the least number of words missing or in between for each opening part of the statement, from any first word.
    """
    a = statement_words(statement)
    if not possible(a, set(text)):
        return
    n, never = len(a), 1 << 30
    drop = [never if tells(w) else 1 for w in a]
    cost, first, ends = [0] * (n + 1), [0] * (n + 1), []
    for i in range(n):
        cost[i + 1] = cost[i] + drop[i]
    for j, w in enumerate(text):
        add = never if tells(w) else 1
        c0, f0 = cost[0], first[0]
        first[0] = j + 1
        for i in range(1, n + 1):
            c, f = cost[i] + add, first[i]
            if cost[i - 1] + drop[i - 1] < c:
                c, f = cost[i - 1] + drop[i - 1], first[i - 1]
            if a[i - 1] == w and c0 <= c:
                c, f = c0, f0
            c0, f0, cost[i], first[i] = cost[i], first[i], c, f
        if cost[n] <= 2 * MISSING * n:
            ends.append((cost[n], first[n], j + 1))
    taken: list[tuple[int, int]] = []
    for _, i, j in sorted(ends):
        k = bisect.bisect(taken, (i, j))
        if k and taken[k - 1][1] > i or k < len(taken) and taken[k][0] < j:
            continue
        lacks, has = differences(statement, " ".join(text[i:j]))
        if confirmed(statement, lacks, has):
            taken.insert(k, (i, j))
            yield i, j, lacks, has


def find_statements(text: str, templates: tuple[tuple[str, tuple[str, ...]], ...]) -> list[tuple[int, int, str, list[str], list[str]]]:
    """(start, stop, license, missing words, other words) of all confirmed statements that touch a candidate block.

    A statement may be wrapped over lines and a sentence may end inside it ('v. 2.0'), so a block is searched with the words around
    it, as many as the statement can take. One that stands inside a longer one (a license's first words, say) is left out.
    """
    found = list(_WORD.finditer(text.translate(_LOWER)))
    starts, stops, there = [m.start() for m in found], [m.end() for m in found], [m[0] for m in found]
    blocks = [(start, start + len(block)) for start, block in candidate_blocks(text)]
    edges = [(bisect.bisect_right(stops, start), bisect.bisect_left(starts, stop)) for start, stop in blocks]
    out, k = [], 0
    for name, many in templates:
        for s in many:
            reach = math.ceil((1 + MISSING) * len(statement_words(s)))
            for low, high in _joined([(max(0, a - reach), min(len(found), b + reach)) for a, b in edges]):
                out += [(starts[low + i], stops[low + j - 1], name, lacks, has) for i, j, lacks, has in places(s, there[low:high])]
    out.sort(key=lambda f: (f[0], -f[1], f[2], f[3]))
    whole: list[tuple[int, int, str, list[str], list[str]]] = []
    for f in out:
        if not whole or f[1] > whole[-1][1] or f[:2] == whole[-1][:2]:
            whole.append(f)
    touching = []
    for f in whole:
        while k < len(blocks) and blocks[k][1] <= f[0]:
            k += 1
        if k < len(blocks) and blocks[k][0] < f[1]:
            touching.append(f)
    return touching


def scan_block(block: str, templates: tuple[tuple[str, tuple[str, ...]], ...], found: Sequence[tuple[int, int, str, list[str], list[str]]] = ()) -> list[tuple[str, int, list[str], list[str], bool]]:
    """(license, bytes saved, missing words, other words, confirmed) of each license whose statements are in the block, by bytes saved; of
    the likeliest template if there is none. ``found`` are the confirmed statements; words of one that is taken count for no other license.
    """
    plain, with_template = _compressors(templates)
    data = block.encode()
    alone = len(plain.compress(data))
    saved = sorted(((alone - len(c.compress(data)), name) for name, c in with_template), key=lambda x: (-x[0], x[1]))
    taken: list[tuple[int, int]] = []
    out = []
    for gain, name in saved:  # whatever it saves: what stands twice in a block saves little the second time
        own = []
        for f in found:
            if f[2] == name:
                k = bisect.bisect_right(taken, (f[0], f[0]))
                if not (k and taken[k - 1][1] > f[0] or k < len(taken) and taken[k][0] < f[1]):
                    own.append(f)
        if own:
            taken = _joined(taken + [f[:2] for f in own])
            _, _, _, lacks, has = min(own, key=lambda f: len(f[3]) + len(f[4]))
            out.append((name, gain, lacks, has, True))
    if out:
        return out
    first = None
    for gain, name in saved:
        if gain <= 0 and first is not None:
            break
        tried = [(s, *differences(s, block)) for s in dict(templates)[name]]
        ok = [t for t in tried if confirmed(*t)]
        best = min(ok or tried, key=lambda t: len(t[1]) + len(t[2]))
        if ok:
            return [(name, gain, best[1], best[2], True)]
        first = first or (name, gain, best[1], best[2], False)
    return [first]


def scan_text(text: str, templates: tuple[tuple[str, tuple[str, ...]], ...]) -> Iterator[tuple[int, int, int, str | None, str, int, list[str], list[str]]]:
    """The rows of one text, without its id."""
    found = find_statements(text, templates)
    k = 0
    for n, (start, block) in enumerate(candidate_blocks(text, [f[:2] for f in found])):
        own = []
        while k < len(found) and found[k][0] < start + len(block):
            own.append(found[k])
            k += 1
        for name, gain, lacks, has, ok in scan_block(block, templates, own):
            yield n, start, len(block), name if ok else None, name, gain, lacks, has


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Mapping[str, Sequence[str]] = TEMPLATES) -> DataFrame:
    """A row for each candidate block, or for each license confirmed in it: id, block (number in the text, from 0), start
    (character), length, license (of the confirmed template, else null), likeliest (template), saved (bytes), missing and other
    (words). A license that stands in a block several times is one row.

    Texts without a candidate, null and empty ones give no row. Repeated rows give their rows each. Equal savings go by
    license name. An empty table gives an empty result. Other columns are not read. Whole texts are searched.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("block", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("license", T.StringType()), T.StructField("likeliest", T.StringType()), T.StructField("saved", T.LongType()), T.StructField("missing", T.ArrayType(T.StringType())), T.StructField("other", T.ArrayType(T.StringType()))]
    schema = to_arrow_schema(T.StructType(fields))
    fixed = tuple((name, tuple(s)) for name, s in templates.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch.column(1)):
                for row in scan_text(text.as_py(), fixed):
                    at.append(i)
                    rows.append(row)
            if rows:
                ids = batch.column(0).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([ids.cast(schema.field(0).type), *(pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(schema)[1:], strict=True))], schema=schema)

    texts = docs.where(F.col(text_col).rlike(SIGNAL)).select(F.col(id_col), F.col(text_col).alias("_text"))
    return texts.mapInArrow(run, T.StructType(fields))


def op8_licenses(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
