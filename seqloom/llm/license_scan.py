"""License notices by conditional compression.

Blocks of text around words that licenses use are candidates. Each is compressed with zstandard, once by itself and once
with each template as a raw dictionary: what a template saves tells how much of the block it explains. All templates
are compared word by word, those that save most first; a template is confirmed if the differences are few and touch none of the
words that tell licenses apart.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, pick

# Notices and texts as their stewards publish them; <...> stands for what differs from use to use.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ),
    (
        "ISC",
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of <holder> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, <holder> has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("all-rights-reserved", "All rights reserved."),
)
#: Words that propose a block, and words that tell one license from another: a difference in one of these is never accepted.
TRIGGER = re.compile(r"licen[cs]|copyright|redistribut|unencumbered|all rights reserved|permission (?:is|to)\b|public domain|creative commons|waived all", re.I)
TELLING = frozenset("apache mit bsd gnu lesser affero mozilla mpl creative commons cc by nc sa nd sharealike noncommercial noderivatives attribution version v later neither not reserved hereby unencumbered waived".split())
LEVEL, NEAR, EDGE, WIDE, LONGEST, OVERLAP = 19, 400, 200, 1200, 8000, 3000
MIN_SAVED, MAX_DIFF, SHORT = 0.25, 0.1, 40

_WORD = re.compile(r"<[a-z]+>|[^\W_]+(?:\.[0-9]+)*")


#: The number of a list's item, at a line's start or after a clause: no word of the wording.
_ITEM = re.compile(r"(?:(?:^|\n)[ \t*#/;>-]*+|[:;.,][ \t]++|\b(?:and/or|and|or)[ \t]++)\(?([0-9]{1,2}|[a-d])[.)](?=\s)")


def _words(text: str) -> list[tuple[str, int, int]]:
    """(word in lower case, start, end) of each word but the numbers of a list's items."""
    items = {m.start(1) for m in _ITEM.finditer(text)}
    return [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text) if m.start() not in items]


def blocks(text: str) -> list[tuple[int, int]]:
    """(start, end) of the candidate blocks: triggers that are near one another, out to their lines' ends if these are near.

    A block is at most LONGEST long; a longer stretch gives several that overlap by more than the longest template.
    """
    out: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        a, b = max(0, m.start() - EDGE), min(len(text), m.end() + EDGE)
        if (k := text.rfind("\n", a, m.start())) >= 0:
            a = k + 1
        if (k := text.find("\n", m.end(), b)) >= 0:
            b = k
        if out and a - out[-1][1] <= NEAR:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    cut = []
    for a, b in out:
        while b - a > LONGEST:
            cut.append((a, a + LONGEST))
            a += LONGEST - OVERLAP
        cut.append((a, b))
    return cut


class Scanner:
    """The templates as dictionaries, made once in a task."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES):
        self.templates = [(name, [w for w, _, _ in _words(t)]) for name, t in templates]
        raw = [zstandard.ZstdCompressionDict(t.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT) for _, t in templates]
        self.alone = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.given = [zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False) for d in raw]

    def rank(self, block: str) -> list[tuple[float, int]]:
        """(share of the size saved, template), most first; ties to the earlier template."""
        data = block.lower().encode("utf-8", "surrogatepass")
        whole = len(self.alone.compress(data))
        return sorted(((1 - len(c.compress(data)) / whole, k) for k, c in enumerate(self.given)), key=lambda x: (-x[0], x[1]))

    def differences(self, template: list[str], words: list[str]) -> tuple[int, int, list[str], list[str]]:
        """(first, last + 1, missing, extra) of the stretch of ``words`` that is most like the template."""
        runs = [r for r in SequenceMatcher(None, template, words, autojunk=False).get_matching_blocks() if r.size]
        if not runs:
            return 0, 0, template, []
        a, b = runs[0].b, runs[-1].b + runs[-1].size
        mine, theirs = {i for r in runs for i in range(r.a, r.a + r.size)}, {i for r in runs for i in range(r.b, r.b + r.size)}
        return a, b, [w for i, w in enumerate(template) if i not in mine], [words[i] for i in range(a, b) if i not in theirs]

    def confirm(self, template: list[str], words: list[str]) -> tuple[int, int, int] | None:
        """(first, last + 1, differences) if the wording is the template's, but for a few words that tell nothing."""
        tells = lambda ws: any(w in TELLING or w[0].isdigit() for w in ws)
        # words that are nowhere in the block are missing however it is aligned: most templates need no alignment
        here = set(words)
        absent = [w for w in template if w[0] != "<" and w not in here]
        if tells(absent) or len(absent) > MAX_DIFF * len(template):
            return None
        a, b, missing, extra = self.differences(template, words)
        open_ = [w for w in missing if w[0] == "<"]  # what a placeholder stands for, up to eight words each
        missing, free = [w for w in missing if w[0] != "<"], 8 * len(open_)
        if tells(missing) or (not open_ and tells(extra)) or len(missing) + max(0, len(extra) - free) > MAX_DIFF * len(template):
            return None
        return a, b, len(missing) + len(extra)

    def scan(self, text: str | None) -> list[tuple[str, int, int, float, int]]:
        """(license, start, end, share saved, words that differ) of each notice, by place."""
        found: dict[tuple[int, int], tuple[str, int, int, float, int]] = {}
        text = text or ""
        for start, end in blocks(text):
            # of a long text the triggers show a part only: a block that a long template explains in part is taken with what is around it
            saved, k = self.rank(text[start:end])[0]
            wide = WIDE if saved >= MIN_SAVED and len(self.templates[k][1]) > SHORT else 0
            self._scan(text, max(0, start - wide), min(len(text), end + wide), found)
        return [found[k] for k in sorted(found)]

    def _scan(self, text: str, start: int, end: int, found: dict) -> None:
        words = _words(text[start:end])
        while words:
            block = text[start + words[0][1] : start + words[-1][2]]
            best = None
            for saved, k in self.rank(block):  # the ranking orders the work only: any template may be the notice
                if (got := self.confirm(self.templates[k][1], [w for w, _, _ in words])):
                    # of templates confirmed, the one that explains most words with the fewest differences
                    best = max(best or (-1,), (got[1] - got[0] - got[2], saved, -k, got))
            if best is None:
                break
            (_, saved, k, (a, b, diff)) = best
            name, run = self.templates[-k][0], [w for w, _, _ in words[a:b]]
            i, rest = 0, []
            while i < len(words):  # the same words elsewhere in the block are the same notice
                if words[i][0] == run[0] and [w for w, _, _ in words[i : i + len(run)]] == run:
                    s, e = start + words[i][1], start + words[i + len(run) - 1][2]
                    found.setdefault((s, e), (name, s, e, round(saved, 4), diff))
                    i += len(run)
                else:
                    rest.append(words[i])
                    i += 1
            words = rest


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """(id_col, notices) for every row; ``notices``: array of (license, start, end, saved, n_diff) by place, code points, end exclusive.

    A null or empty text has none. Repeated rows give repeated results; extra columns take no part; an empty table gives no rows.
    """
    rows = pick(docs, id=id_col, text=text)
    kind = next(f.dataType.simpleString() for f in rows.schema.fields if f.name == "id")
    item = pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("saved", pa.float64()), ("n_diff", pa.int64())])

    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, names = Scanner(templates), item.names if hasattr(item, "names") else [f.name for f in item]
        for b in chunks(it, 1000):
            found = [[dict(zip(names, x, strict=True)) for x in scanner.scan(t)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(item))], ["id", "notices"])

    return rows.mapInArrow(go, f"id {kind}, notices array<struct<license:string,start:long,end:long,saved:double,n_diff:long>>").withColumnRenamed("id", id_col)


def report(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: its licenses, and its notices' places."""
    n = F.col("notices")
    return scan(docs, id_col, text).select(
        id_col,
        F.size(n).cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(n, lambda x: x["license"]))), ",").alias("licenses"),
        F.array_join(F.transform(n, lambda x: F.concat_ws(":", x["license"], x["start"], x["end"], x["n_diff"])), ",").alias("spans"),
        F.coalesce(F.array_max(F.transform(n, lambda x: x["saved"])), F.lit(0.0)).alias("most_saved"),
    )
