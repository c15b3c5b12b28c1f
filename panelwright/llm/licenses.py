"""License notices found by conditional compression and confirmed by their wording.

A text's lines with licensing words, and short gaps between them, form candidate blocks. Each block is compressed alone
and with every template as a raw zstandard dictionary; the templates are ranked by the bytes that each saves. Down this
ranking they are compared with the block word by word, and the first that is confirmed is taken: nearly all of its words
occur in order, little stands between them, no decisive word (a number, or a word that tells licenses apart) differs, and no
"only" or "or later" follows. It is cut out of the block and the rest is compressed again, so a block may hold several.
Long blocks are looked at in overlapping windows that any notice fits into. What follows "or" or "and" behind an SPDX
identifier is read as another identifier.

Defined cases: null and empty texts have no blocks; blocks of any length are taken whole; of templates that save alike the
first by name is compared first; repeated rows are scanned row by row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from difflib import SequenceMatcher

import zstandard
from pyspark.sql import DataFrame

from .arrow import map_texts

# Public license notices.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS
IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""
BSD3 = BSD + """ Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""
GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} Public
License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later
version."""
EPL = """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
BOOST = """Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at
https://www.boost.org/LICENSE_1_0.txt)"""
NOTICES: dict[str, list[str]] = {
    "Apache-2.0": [APACHE],
    "BSD-2-Clause": [BSD],
    "BSD-3-Clause": [BSD3],
    "BSL-1.0": [BOOST],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Licensed under CC0 1.0.", "This work is dedicated to the public domain under CC0 1.0 Universal."],
    "EPL-2.0": [EPL],
    "ISC": [ISC],
    "MIT": [MIT],
    "MPL-2.0": [MPL, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Proprietary": ["All rights reserved."],
}
#: Names that stand in one-line forms.
TITLES: dict[str, list[str]] = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License, version 2.0", "Eclipse Public License v2.0"],
    "ISC": ["ISC License"],
    "MIT": ["MIT License"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0"],
    "Unlicense": ["Unlicense"],
}
LEADS = ("Licensed under the {}.", "Released under the {}.", "Under the terms of the {}.")
FAMILIES = {"GPL": ("General", ["2.0", "3.0"]), "LGPL": ("Lesser General", ["2.1", "3.0"]), "AGPL": ("Affero General", ["3.0"])}
# End of the fixed values.


def all_templates() -> dict[str, list[str]]:
    """Notices, one-line forms and SPDX lines of every license."""
    out = {name: list(texts) for name, texts in NOTICES.items()}
    for name, titles in TITLES.items():
        out[name] += [lead.format(title) for title in titles for lead in LEADS]
    for short, (kind, versions) in FAMILIES.items():
        for version in versions:
            name, number = f"{short}-{version}", version.removesuffix(".0")
            title = f"GNU {kind} Public License"
            plain = [f"{title}, version {number}", f"{title} v{version}", f"Licensed under {short}v{number}"]
            plain += [f"{title}, version {version}", f"{title} v{number}"] if number != version else []
            out[name] = plain
            out[f"{name}-only"] = [f"{form} only" for form in plain]
            out[f"{name}-or-later"] = [f"{form} or later" for form in plain]
            out[f"{name}-or-later"] += [f"{title}, version {number} or any later version", GNU.format(kind, number)]
    for name in out:
        if name != "Proprietary":
            out[name].append(f"SPDX-License-Identifier: {name}")
    return out


TEMPLATES = all_templates()
#: Words whose presence or absence makes another license.
DECISIVE = frozenset("nc nd sa noncommercial noderivatives sharealike apache mit bsd isc gnu gpl lgpl lesser affero agpl cc0 "
                     "mozilla eclipse boost unlicense not neither no non only later clause".split())
STRONG = re.compile(r"licen[sc]e|copyright|©|warrant|permission|spdx|redistribut|public domain|creative commons"
                    r"|rights reserved|\bcc[- ]by|\bcc0|\b[al]?gpl", re.IGNORECASE)
#: One of these stands in every strong word, in lower case.
HINTS = ("licen", "copyright", "©", "warrant", "permission", "spdx", "redistribut", "public domain", "creative commons",
         "rights reserved", "cc by", "cc-by", "cc0", "gpl")
WEAK = re.compile(r"software|liab|merchantab|damages|notice|conditions|copies|sublicen|distribut|modif|provided"
                  r"|disclaimer|source code|foundation|contract|tort|version", re.IGNORECASE)
NUMBER = re.compile(r"v?\d")
SPDX = ["spdx", "license", "identifier"]
GAP, COVERED, EXTRA = 2, 0.9, 0.25
WORDS = re.compile(r"[^\W_]+(?:\.\d+)*")
#: Characters of blocks whose notices a task remembers.
MEMORY = 4_000_000


def words_of(text: str) -> list[str]:
    return [w.lower() for w in WORDS.findall(text)]


def blocks_of(text: str) -> list[tuple[int, int]]:
    """Character ranges of candidate blocks: runs of lines with licensing words, gaps of ``GAP`` lines allowed, that hold
    a strong word."""
    low = text.lower()
    if not any(hint in low for hint in HINTS):
        return []
    out, run, at = [], None, 0
    for line in text.split("\n"):
        end = at + len(line)
        strong = STRONG.search(line) is not None
        if strong or WEAK.search(line):
            if run is None:
                run = [at, end, strong, 0]
            else:
                run = [run[0], end, run[2] or strong, 0]
        elif run is not None:
            run[3] += 1
            if run[3] > GAP:
                out.append(run)
                run = None
        at = end + 1
    out += [run] if run is not None else []
    return [(a, b) for a, b, strong, _ in out if strong]


@dataclass(frozen=True)
class Notice:
    """A confirmed license: its name, words of the block it covers, and how it differs from the template."""

    name: str
    begin: int
    end: int
    reduction: float
    missing: tuple[str, ...]
    added: tuple[str, ...]


class Scanner:
    """Templates ready for compression and comparison."""

    def __init__(self, templates: dict[str, list[str]]):
        self.plain = zstandard.ZstdCompressor(level=6)
        self.templates = []
        for name in sorted(templates):
            for text in templates[name]:
                own = words_of(text)
                raw = zstandard.ZstdCompressionDict(self.canonical(own), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                raw.precompute_compress(level=6)
                self.templates.append((name, own, zstandard.ZstdCompressor(level=6, dict_data=raw)))
        self.bags = [Counter(own) for _, own, _ in self.templates]
        self.sizes = [self.size(own) for _, own, _ in self.templates]
        #: Words that the longest notice may take.
        self.longest = max((self.extent(own) for _, own, _ in self.templates), default=1)

    @staticmethod
    def canonical(words: list[str]) -> bytes:
        return (" " + " ".join(words) + " ").encode()

    @staticmethod
    def extent(own: list[str]) -> int:
        """Words that a notice with these words may take."""
        return len(own) + int(EXTRA * len(own))

    def size(self, words: list[str]) -> int:
        """Compressed size of words alone."""
        return len(self.plain.compress(self.canonical(words)))

    def ranked(self, words: list[str]) -> list[tuple[int, int]]:
        """All templates by the bytes that each saves when the block is compressed with it."""
        data = self.canonical(words)
        alone = len(self.plain.compress(data))
        saved = [(alone - len(compressor.compress(data)), i) for i, (_, _, compressor) in enumerate(self.templates)]
        return sorted(saved, key=lambda x: (-x[0], x[1]))

    def confirm(self, words: list[str], index: int, reduction: float) -> Notice | None:
        """The template's place in the block, if the wording agrees; the first of those that cover most."""
        own, step = self.templates[index][1], self.extent(self.templates[index][1])
        # words far from the notice must not count as its words
        found = [n for at in range(0, max(len(words) - step, 1), step)
                 if (n := self.confirm_window(words[at:at + 2 * step], at, index, reduction))]
        return max(found, key=lambda n: n.end - n.begin - len(n.added), default=None) if own else None

    def confirm_window(self, words: list[str], at: int, index: int, reduction: float) -> Notice | None:
        """The template's place in a few words that start at a place of the block, if the wording agrees."""
        name, own, _ = self.templates[index]
        there = Counter(words)
        if sum(min(k, there[w]) for w, k in self.bags[index].items()) < COVERED * len(own):
            return None
        pairs = [m for m in SequenceMatcher(None, own, words, autojunk=False).get_matching_blocks() if m.size]
        if sum(m.size for m in pairs) < COVERED * len(own):
            return None
        begin, end = pairs[0].b, pairs[-1].b + pairs[-1].size
        missing, added, i, j = [], [], 0, begin
        for m in pairs:
            missing += own[i:m.a]
            added += words[j:m.b]
            i, j = m.a + m.size, m.b + m.size
        missing += own[i:]
        decisive = lambda ws: any(w in DECISIVE or NUMBER.match(w) for w in ws)
        after = words[end:end + 2]
        if len(added) > EXTRA * len(own) or decisive(missing) or decisive(added) or after[:1] == ["only"] or after == ["or", "later"]:
            return None
        return Notice(name, at + begin, at + end, round(max(0.0, min(1.0, reduction)), 6), tuple(missing), tuple(added))

    def scan(self, words: list[str]) -> list[Notice]:
        """All notices of a block in order."""
        step, found = self.longest, set()
        for at in range(0, max(len(words) - step, 1), step):  # any notice lies in one window as a whole
            found.update(self.scan_window(words[at:at + 2 * step], at))
        # a window may cut a notice so that a shorter one is seen in the rest: of those that overlap the longest holds
        out: list[Notice] = []
        taken = bytearray(len(words))
        for n in sorted(found, key=lambda n: (n.begin - n.end + len(n.added), -n.reduction, n.begin, n.name)):
            if not any(taken[n.begin:n.end]):
                taken[n.begin:n.end] = b"\1" * (n.end - n.begin)
                out.append(n)
        return sorted(out, key=lambda n: n.begin)

    def scan_window(self, words: list[str], offset: int) -> list[Notice]:
        """All notices of a window in order."""
        out, todo = [], [(offset, words, offset)]
        while todo:
            at, part, least = todo.pop()
            if len(part) < 3:
                continue
            size = self.size(part)
            best = next((n for saved, i in self.ranked(part)
                         if (n := self.confirm(part, i, saved / min(size, self.sizes[i])))), None)
            if best is None:
                continue
            begin, end = best.begin, best.end
            out.append(Notice(best.name, max(at + begin, least), at + end, best.reduction, best.missing, best.added))
            todo.append((at, part[:begin], least))
            if part[begin:begin + 3] == SPDX and part[end:end + 1] in (["or"], ["and"]):  # an identifier follows
                todo.append((at + end - 2, SPDX + part[end + 1:], at + end + 1))
            else:
                todo.append((at + end, part[end:], at + end))
        return sorted(out, key=lambda n: n.begin)


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, list[str]] | None = None,
) -> DataFrame:
    """``(id_col, n_blocks, licenses, notices)`` of every row: sorted distinct license names, and for each notice its name,
    its character range in the text, size reduction, and the words missing from and added to the template."""
    chosen = templates or TEMPLATES

    def make():
        scanner = Scanner(chosen)
        known: dict[str, list[Notice]] = {}
        held = 0

        def notices(block: str) -> list[Notice]:
            nonlocal held
            if block not in known:
                if held + len(block) > MEMORY:
                    known.clear()
                    held = 0
                known[block] = scanner.scan(words_of(block))
                held += len(block)
            return known[block]

        def work(texts: list[str]) -> list:
            counts, names, rows = [], [], []
            for text in texts:
                blocks, found = blocks_of(text), []
                for a, b in blocks:
                    block = text[a:b]
                    spans = None
                    for n in notices(block):
                        spans = spans or [m.span() for m in WORDS.finditer(block)]
                        found.append({"name": n.name, "begin": a + spans[n.begin][0], "end": a + spans[n.end - 1][1],
                                      "reduction": n.reduction, "missing": list(n.missing), "added": list(n.added)})
                counts.append(len(blocks))
                names.append(sorted({f["name"] for f in found}))
                rows.append(found)
            return [counts, names, rows]

        return work

    new = ("n_blocks int, licenses array<string>, notices array<struct<name:string,begin:int,end:int,reduction:double,"
           "missing:array<string>,added:array<string>>>")
    return map_texts(docs, [id_col], text_col, new, make)
