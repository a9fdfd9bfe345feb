"""License scan by conditional compression.

Every template gives its own cues: one more of its words than it may lack, the longest ones, so a
notice shows at least one.  Where a cue stands, a window of words is cut that is a little longer than
the template and in which the template's words may all be found but for those it may lack.

A window is compressed alone and once with each template as raw zstandard dictionary.  The bytes that
a template saves rank it; one that saves less than SHARE of what it compresses to itself is out.
Down this ranking a template is confirmed wherever the exact differences in wording (template
words that are missing, words that stand between the matched ones) are few enough and its place is not
taken by a winner before it, until no cue of the window is left unexplained.  So the
reduction selects and orders, and the exact check decides.

The scan covers whole texts in one pass without shuffle, whatever their lines are; a worker keeps the
results of the distinct windows it has seen, up to a number of bytes.  Offsets are code points, ends
exclusive.  Null and empty texts have no rows; repeated rows give repeated findings; a null id is
kept; an empty table gives an empty one; other columns play no part, whatever their names.
"""

from __future__ import annotations

import re
import string
from bisect import bisect_right
from collections import defaultdict
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.llm.common import lean, pick, setup

# Wording of public licenses and of the usual one-line notices, by SPDX name.
_MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES "
    "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
    "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
    "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
    "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_GNU_WARRANTY = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {} for more details.")
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
            "notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _MIT_WARRANTY],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
             "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
             "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
             "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the "
             "original software. If you use this software in a product, an acknowledgment in the product documentation would be "
             "appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
             "misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
             "distribution."],
    "Unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
                  "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
                  "purpose, commercial or non-commercial, and by any means."],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0.",
                "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
                "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
                "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties "
                "to whom the Software is furnished to do so, all subject to the following:"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_WARRANTY],
    "0BSD": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted. " + _ISC_WARRANTY],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", _BSD_START + _BSD_WARRANTY],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.",
                     _BSD_START + "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
                     "endorse or promote products derived from this software without specific prior written permission. " + _BSD_WARRANTY,
                     "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met:"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
                   "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                   "either express or implied. See the License for the specific language governing permissions and limitations "
                   "under the License."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version. " + _GNU_WARRANTY.format("GNU General Public License")],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0."],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0."],
    "Proprietary": ["All rights reserved."],
}
#: Marks of a license line that no template need share: such lines without a notice are reported as unknown.
CUES = ("licen", "copyright", "©", "spdx", "permission is hereby", "permission to use", "rights reserved", "public domain",
        "creative commons", "cc by", "cc0 ", "redistribution and use", "free software")
#: Share of a template's own compressed size that it has to save, and bytes of window results that a worker keeps.
SHARE = 0.3
MAX_CACHE = 32 << 20
_TOKEN = re.compile(r"\S+")


def plain(word: str) -> str:
    return word.lower().strip(string.punctuation)


def words(text: str) -> list[str]:
    return [w for w in map(plain, text.split()) if w]


class Scanner:
    def __init__(self, templates: dict[str, list[str]] | None = None, level: int = 9):
        templates = TEMPLATES if templates is None else templates
        self.notices = [(name, text, words(text)) for name, texts in templates.items() for text in texts if words(text)]
        params = zstandard.ZstdCompressionParameters.from_level(level, write_content_size=False, write_checksum=False, write_dict_id=False,
                                                                format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        self.alone = zstandard.ZstdCompressor(compression_params=params)
        self.given, self.wording, self.worth, self.slack = [], [], [], []
        #: word -> (template, place in it) of which it is a cue
        self.cues: dict[str, list[tuple[int, int]]] = defaultdict(list)
        self.starts: list[frozenset] = []
        for k, (_, _, w) in enumerate(self.notices):
            raw = " ".join(w).encode("utf-8", "replace")
            self.given.append(zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(
                raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)))
            self.worth.append(len(self.alone.compress(raw)))
            self.wording.append(frozenset(w))
            self.slack.append(len(w) // 5)
            lacks = most_missing(w)
            # Distinct words may stand more than once; a notice lacks at most as many of them as of its words.
            for cue in sorted(dict.fromkeys(w), key=lambda x: (-len(x), x))[:lacks + 1]:
                self.cues[cue] += [(k, p) for p, x in enumerate(w) if x == cue]
            self.starts.append(frozenset(w[:lacks + 1]))
        self.marks = sorted(self.cues, key=len)
        self.seen: dict[str, list] = {}
        self.held = 0

    def winners(self, text: str) -> list[tuple]:
        """((rank), (start, end, license, reduction, missing, extra)) of all notices, the best first."""
        low = text.lower()
        if not any(m in low for m in self.marks):
            return []
        places = [(m.start(), m.end(), w) for m in _TOKEN.finditer(text) if (w := plain(m[0]))]
        mine = [w for _, _, w in places]
        best: dict[tuple, tuple] = {}
        for a, b in self.windows(mine):
            for key, (first, last, *how) in self.judged(mine[a:b]):
                best[a + first, a + last, how[0]] = (key, (places[a + first][0], places[a + last - 1][1], *how))
        return apart(best.values())

    def judge(self, text: str):
        """(license, reduction, missing, extra) of the best notice, or None."""
        return found[0][1][2:] if (found := self.winners(text)) else None

    def found(self, text: str) -> list[tuple]:
        """(start, end, license, reduction, missing, extra) of every notice, in order."""
        return sorted(notice for _, notice in self.winners(text))

    def scan(self, text: str) -> list[tuple]:
        """The notices, and the license lines without one as ``unknown``, in order."""
        found = self.found(text)
        return sorted([*found, *self.unknown(text, [n[:2] for n in found])], key=lambda n: n[:2])

    def windows(self, mine: list[str]) -> list[tuple[int, int]]:
        """Ranges of words that may be a notice, by its cue's place and by the words it has to have."""
        out = set()
        for i, w in enumerate(mine):
            for k, p in self.cues.get(w, ()):
                a, b = max(0, i - p - self.slack[k]), min(len(mine), i - p + len(self.notices[k][2]) + self.slack[k])
                if (a, b) not in out and len(self.wording[k].difference(mine[a:b])) <= most_missing(self.notices[k][2]):
                    out.add((a, b))
        return sorted(out)

    def judged(self, window: list[str]) -> list[tuple]:
        """((rank), (first, last, license, reduction, missing, extra)) of the notices in a window of words."""
        text = " ".join(window)
        if text not in self.seen:
            if self.held > MAX_CACHE:
                self.seen.clear()
                self.held = 0
            self.held += 500 + 2 * len(text)
            self.seen[text] = self.confirmed(window, self.ranked(text))
        return self.seen[text]

    def ranked(self, text: str) -> list[tuple[int, int, float]]:
        """(bytes saved, template, reduction) of the templates that save enough, the most bytes first."""
        raw = text.encode("utf-8", "replace")
        size = len(self.alone.compress(raw))
        saved = [(size - len(c.compress(raw)), k) for k, c in enumerate(self.given)]
        return [(n, k, n / size) for n, k in sorted(saved, key=lambda x: (-x[0], x[1])) if n >= SHARE * self.worth[k]]

    def confirmed(self, window: list[str], ranking) -> list[tuple]:
        """Down the ranking, until every cue of the window stands in a confirmed notice."""
        taken: list[tuple[int, int]] = []
        open_cues = {i for i, w in enumerate(window) if w in self.cues}
        out = []
        for place, (saved, k, reduction) in enumerate(ranking):
            if not open_cues:
                break
            name, _, theirs = self.notices[k]
            here = []
            for at, word in enumerate(window):
                if word not in self.starts[k]:
                    continue
                part = window[at:at + len(theirs) + self.slack[k]]
                if len(self.wording[k].difference(part)) > most_missing(theirs):
                    continue
                missing, extra, first, last = differences(theirs, part)
                if missing <= most_missing(theirs) and extra <= 0.2 * len(theirs):
                    here.append((missing + extra, at + first, at + last, missing, extra))
            for off, first, last, missing, extra in sorted(here):
                if all(last <= a or first >= b for a, b in taken):
                    taken.append((first, last))
                    open_cues.difference_update(range(first, last))
                    out.append(((-saved, off, place), (first, last, name, reduction, missing, extra)))
        return out

    @staticmethod
    def unknown(text: str, found: list[tuple[int, int]]):
        """Runs of lines with a general cue that no notice touches."""
        low = text.lower()
        if not any(c in low for c in CUES):
            return
        start = end = None
        at = 0

        def free(a, b):
            i = bisect_right(found, (b, -1))
            return i == 0 or found[i - 1][1] <= a
        for line in [*text.split("\n"), "x"]:
            cued = line.strip() and any(c in line.lower() for c in CUES)
            if cued:
                start = at if start is None else start
                end = at + len(line)
            elif start is not None and line.strip():
                if free(start, end):
                    yield start, end, "unknown", None, None, None
                start = None
            at += len(line) + 1


def apart(candidates) -> list[tuple]:
    """The candidates, best first, without those that overlap a better one."""
    starts, ends, kept = [], [], []
    for key, notice in sorted(candidates, key=lambda c: (c[0], c[1][:3])):
        i = bisect_right(starts, notice[0])
        if (i == 0 or ends[i - 1] <= notice[0]) and (i == len(starts) or notice[1] <= starts[i]):
            starts.insert(i, notice[0])
            ends.insert(i, notice[1])
            kept.append((key, notice))
    return kept


def most_missing(theirs: list[str]) -> int:
    return len(theirs) // 20


def differences(theirs: list[str], window: list[str]) -> tuple[int, int, int, int]:
    """Template words that the window lacks, window words between the first and last matched one,
    and the range of the window from the first to the last matched word."""
    found = [m for m in SequenceMatcher(None, theirs, window, autojunk=False).get_matching_blocks() if m.size]
    if not found:
        return len(theirs), 0, 0, 0
    equal = sum(m.size for m in found)
    first, last = found[0].b, found[-1].b + found[-1].size
    return len(theirs) - equal, last - first - equal, first, last


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict | None = None) -> DataFrame:
    """(id, license, block_start, block_end, reduction, missing, extra): one row a confirmed notice with the
    offsets of its matched words, the reduction being that of its window; license lines without a
    notice have one row a run, license ``unknown`` and nulls."""
    setup(docs.sparkSession)
    rows = pick(docs, _id=id_col, _text=text_col)
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        scanner = Scanner(templates)
        for b in batches:
            got = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for start, end, name, *how in scanner.scan(t or ""):
                    got.append((i, name, start, end, *how))
            if got:
                cols = list(zip(*got))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], b.schema.field(0).type), pa.array(cols[1], pa.string()), *(pa.array(c, pa.int64()) for c in cols[2:4]),
                     pa.array(cols[4], pa.float64()), *(pa.array(c, pa.int64()) for c in cols[5:])],
                    ["_id", "license", "block_start", "block_end", "reduction", "missing", "extra"])

    schema = f"_id {kind}, license string, block_start long, block_end long, reduction double, missing long, extra long"
    return rows.mapInArrow(lean(run), schema).withColumnRenamed("_id", id_col)


def licenses(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, licenses, blocks): the sorted names found in each document that has any block, and its rows of ``found``."""
    return found.groupBy(id_col).agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
                                     F.count(F.lit(1)).alias("blocks"))
