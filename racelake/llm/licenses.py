"""License notices by conditional compression.

Candidates are the places of a document that hold enough of a template's
words in order. Each is compressed alone and again with its template as a
zstandard raw dictionary; the more bytes the template saves, the higher the
candidate ranks. Where candidates overlap the first in rank wins, and winners
are reported with their exact differences in wording. The saving ranks only:
a candidate without a rival is found whatever it saves.

Candidates are looked for around the templates' tell-tale words. Those are chosen so
that a notice without any of them could not be confirmed, so no notice is
lost by not looking at the rest of the text.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from racelake.llm.bpe import text_groups
from racelake.llm.common import id_and_text

# Usual wordings of license notices and full texts of short licenses.
_BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the "
    "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
    "in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR '
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
    "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
    "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
    "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
    "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE "
    "OF THIS SOFTWARE.")
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version."),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files, to deal in the Software without restriction"),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "GPL-2.0-or-later": (
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either version 2 "
        "of the License, or (at your option) any later version."),
    "LGPL-3.0-or-later": (
        "This library is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."),
    "AGPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
        "of the MPL was not distributed with this file, You can obtain one at"),
    "CC0-1.0": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and "
        "neighboring rights to this software to the public domain worldwide. This software is "
        "distributed without any warranty."),
    "MIT-full": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without '
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of "
        'the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR '
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."),
    "BSD-2-Clause-full": _BSD_OPENING + _BSD_WARRANTY,
    "BSD-3-Clause-full": _BSD_OPENING + (
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission. ") + _BSD_WARRANTY,
    "ISC-full": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies. ") + _ISC_WARRANTY,
    "0BSD-full": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted. ") + _ISC_WARRANTY,
    "Zlib-full": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will "
        "the authors be held liable for any damages arising from the use of this software. Permission "
        "is granted to anyone to use this software for any purpose, including commercial applications, "
        "and to alter it and redistribute it freely, subject to the following restrictions: 1. The "
        "origin of this software must not be misrepresented; you must not claim that you wrote the "
        "original software. If you use this software in a product, an acknowledgment in the product "
        "documentation would be appreciated but is not required. 2. Altered source versions must be "
        "plainly marked as such, and must not be misrepresented as being the original software. 3. "
        "This notice may not be removed or altered from any source distribution."),
    "Unlicense-full": (
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. "
        "In jurisdictions that recognize copyright laws, the author or authors of this software "
        "dedicate any and all copyright interest in the software to the public domain. We make this "
        "dedication for the benefit of the public at large and to the detriment of our heirs and "
        "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of "
        "all present and future rights to this software under copyright law."),
}
SHARE = 0.8  # of a template's words that must occur, in order
LEVEL = 3

_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


class Scanner:
    """Templates with their dictionaries, tell-tale words and automaton."""

    def __init__(self, templates: dict[str, str] = TEMPLATES, share: float = SHARE):
        import ahocorasick
        import zstandard as zstd

        self.share = share
        self.names = list(templates)
        self.words = [words(templates[n]) for n in self.names]
        raw = zstd.DICT_TYPE_RAWCONTENT
        self.compress = [zstd.ZstdCompressor(level=LEVEL, dict_data=zstd.ZstdCompressionDict(
            " ".join(w).encode(), dict_type=raw), write_content_size=False) for w in self.words]
        self.plain = zstd.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.reach = [int(len(w) / share) + 1 for w in self.words]  # words of the longest place
        # Per template its rarest words over all templates, until fewer than
        # ``share`` of the template's words are left over.
        often: dict[str, int] = {}
        for w in self.words:
            for x in set(w):
                often[x] = often.get(x, 0) + 1
        self.telling: dict[str, set[int]] = {}  # word: templates that it tells of
        for k, w in enumerate(self.words):
            rest = list(w)
            for x in sorted(set(w), key=lambda x: (-len(x), often[x], x)):
                if len(rest) < share * len(w):
                    break
                rest = [y for y in rest if y != x]
                self.telling.setdefault(x, set()).add(k)
        self.find = ahocorasick.Automaton()
        for x in self.telling:
            self.find.add_word(x, len(x))
        self.find.make_automaton()

    def blocks(self, text: str):
        """(first word, words, templates told of) around tell-tale words, wide
        enough for any template told of to begin or end there; tell-tale words
        at most 4 apart share a block, those of one template at most an eighth
        of its reach apart."""
        low = text.lower()
        if next(self.find.iter(low), None) is None:
            return
        tokens = words(text)
        hits = [i for i, w in enumerate(tokens) if w in self.telling]
        i = 0
        while i < len(hits):
            j = i
            while j + 1 < len(hits):
                both = self.telling[tokens[hits[j]]] & self.telling[tokens[hits[j + 1]]]
                if hits[j + 1] - hits[j] > max([4, *(self.reach[k] // 8 for k in both)]):
                    break
                j += 1
            told = set().union(*(self.telling[tokens[h]] for h in hits[i:j + 1]))
            reach = max(self.reach[k] for k in told)
            lo = max(0, hits[i] - reach)
            yield lo, tokens[lo:hits[j] + reach + 1], told
            i = j + 1

    def saved(self, part: list[str], k: int) -> int:
        """Bytes that template k as dictionary saves on a candidate. Noise of
        the compressor can make the saving of a short notice zero or less."""
        data = " ".join(part).encode()
        return len(self.plain.compress(data)) - len(self.compress[k].compress(data))

    def places(self, block: list[str], k: int) -> list[tuple[int, int]]:
        """(first word, end) of template k's places in a block. A place begins
        and ends with words of the template and has ``share`` of the longer of
        template and place as a common subsequence. Of all sets of places that
        do not overlap: the most places, then the most words found, then the
        shortest places."""
        want = self.words[k]
        least, longest = self.share * len(want), int(len(want) / self.share) + 1
        at: dict[str, int] = {}
        for i, w in enumerate(want):
            at[w] = at.get(w, 0) | 1 << i
        masks = [at.get(w, 0) for w in block]
        known = [0, *accumulate(m > 0 for m in masks)]
        full = (1 << len(want)) - 1
        ends: dict[int, list[tuple[int, int]]] = {}  # end: (first, words found)
        for first, m in enumerate(masks):
            stop = min(first + longest, len(block))
            if not m or known[stop] - known[first] < least:
                continue
            rest, found = full, 0  # bit-parallel: zero bits of rest are words found
            for end in range(first + 1, stop + 1):
                hit = rest & masks[end - 1]
                rest = (rest + hit | rest - hit) & full
                n = len(want) - rest.bit_count()
                if n > found and n >= self.share * max(len(want), end - first):
                    ends.setdefault(end, []).append((first, n))
                found = n
        # Best set up to each end that has a place.
        cuts, best = [0], [((0, 0, 0), None)]
        for end in sorted(ends):
            top = best[-1]
            for first, n in ends[end]:
                before = bisect_right(cuts, first) - 1
                x = best[before][0]
                score = (x[0] + 1, x[1] + n, x[2] - (end - first))
                if score > top[0]:
                    top = score, (first, end, before)
            if top is not best[-1]:
                cuts.append(end)
                best.append(top)
        out, i = [], len(best) - 1
        while i > 0:
            first, end, i = best[i][1]
            out.append((first, end))
        return out[::-1]

    def compare(self, part: list[str], k: int) -> tuple[float, list[str]]:
        """Share of template k's words found in order in a place, and the
        differences in wording."""
        want = self.words[k]
        if part == want:
            return 1.0, []
        size = [[0] * (len(part) + 1) for _ in range(len(want) + 1)]
        for i in range(len(want) - 1, -1, -1):
            for j in range(len(part) - 1, -1, -1):
                size[i][j] = size[i + 1][j + 1] + 1 if want[i] == part[j] else max(size[i + 1][j], size[i][j + 1])
        notes, i, j, a, b = [], 0, 0, 0, 0
        while True:
            done = i == len(want) and j == len(part)
            if done or (i < len(want) and j < len(part) and want[i] == part[j]):
                if i > a or j > b:
                    op = "insert" if i == a else "delete" if j == b else "replace"
                    notes.append(f"{op}:{' '.join(want[a:i])}>{' '.join(part[b:j])}")
                if done:
                    return size[0][0] / len(want), notes
                i, j = i + 1, j + 1
                a, b = i, j
            elif j == len(part) or (i < len(want) and size[i + 1][j] >= size[i][j + 1]):
                i += 1
            else:
                j += 1

    def scan(self, text: str) -> list[dict]:
        """Notices of a text, by place. Of overlapping candidates the one that
        its template saves most bytes of wins (then the longer, the earlier,
        the first by name). Where a candidate gives way to another's, what is
        left on its sides is searched again for its template."""
        out: list[dict] = []
        tokens: list[str] = []
        regions = [(at, block, told) for at, block, told in self.blocks(text)]
        while regions:
            found = {}
            for at, block, told in regions:
                for k in told:
                    for a, b in self.places(block, k):
                        key = (at + a, at + b, k)
                        if key not in found:
                            found[key] = self.saved(block[a:b], k), block[a:b]
            starts, ends, lost = [x["first"] for x in out], [x["end"] for x in out], []
            for first, end, k in sorted(found, key=lambda x: (-found[x][0], x[0] - x[1], x[0], self.names[x[2]])):
                i = bisect_left(starts, end)  # so many taken places begin before this one's end
                if i and ends[i - 1] > first:
                    lost.append((first, end, k))
                    continue
                saved, part = found[first, end, k]
                share, notes = self.compare(part, k)
                starts.insert(i, first)
                ends.insert(i, end)
                out.insert(i, {"license": self.names[k], "first": first, "end": end,
                               "saved": saved, "share": share, "differences": notes})
            regions = []
            for first, end, k in lost:
                tokens = tokens or words(text)
                i, j = bisect_right(ends, first), bisect_left(starts, end)  # taken places across it
                borders = [ends[i - 1] if i else 0, *(x for t in range(i, j) for x in (starts[t], ends[t])),
                           starts[j] if j < len(starts) else len(tokens)]
                for lo, hi in zip(borders[::2], borders[1::2]):
                    lo, hi = max(lo, first - self.reach[k]), min(hi, end + self.reach[k])
                    if lo < hi:
                        regions.append((lo, tokens[lo:hi], [k]))
        return out


_SCANNERS: dict = {}
_FOUND = pa.list_(pa.struct([("license", pa.string()), ("first", pa.int64()), ("end", pa.int64()),
                             ("saved", pa.int64()), ("share", pa.float64()), ("differences", pa.list_(pa.string()))]))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, share: float = SHARE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_notices`` and ``notices`` (array
    of license, first and end word, bytes saved, share of the wording found
    and differences in wording), by place. NULL and blank texts have none."""
    chosen = dict(templates or TEMPLATES)

    def run(batches):
        key = (tuple(chosen.items()), share)
        if key not in _SCANNERS:
            _SCANNERS[key] = Scanner(chosen, share)
        find = _SCANNERS[key].scan
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in text_groups(texts):
                rows = [find(t) for t in texts[lo:hi]]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array([len(r) for r in rows], pa.int64()),
                     pa.array(rows, _FOUND)], ["doc_id", "n_notices", "notices"])
    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_notices bigint, notices array<struct<license: string, first: bigint, "
             "end: bigint, saved: bigint, share: double, differences: array<string>>>")
