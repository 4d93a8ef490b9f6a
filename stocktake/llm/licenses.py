"""Licence scans: passages against licence templates by Dice over word bigrams.

Text and templates are normalised alike: A-Z in lower case, words are runs of
letters, digits and non-ASCII characters, all else separates. The passages of a document are its lines,
its paragraphs (runs of lines that hold words) and the whole text. A passage A
matches a template B if 2 |A and B| / (|A| + |B|) over distinct word bigrams reaches
the threshold t. Two bounds prune without loss: |A| must lie between
|B| t / (2 - t) and |B| (2 - t) / t, and A must have at least |B| t / (2 - t) bigrams that B
has too, so passages with few bigrams of any template are never looked at.

Windows find what stands inside a longer passage: runs of at most
|B| (2 - t) / t bigrams of a text that begin and end with a bigram of B. They are
asked for notices only where no passage matches, and for whole licences, whose first
paragraph may match another's, only where no passage matches a whole licence.

The templates are a fixed list of some kilobytes that travels with the tasks;
documents are scanned in place, without a shuffle.

Defined results: a whole licence goes before notices; then the best match of a
document counts, ties by the order of the templates, then line, paragraph, text, window. A NULL text, or one without a match, has
licence NULL and Dice 0. Repeated rows each get their result; other columns are ignored. A text is one
block in memory, of some 50 times its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stocktake.llm.common import LOWER, arrow_text, hash_spans, mix64, row_blocks, word_bounds

SCOPES = ("line", "paragraph", "text", "window")

# Licence identifiers with their customary notices or terms.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                "later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
                "later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                     "the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]

# The notices of the GNU licences differ in a word or a number.
_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} General Public License "
        "as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
NOTICES: list[tuple[str, str]] = [
    ("AGPL-3.0", _GNU.format("Affero", "3")),
    ("LGPL-3.0", _GNU.format("Lesser", "3")),
    ("LGPL-2.1", _GNU.format("Lesser", "2.1").replace("This program", "This library")),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
]
_AS_IS = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
          "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
          "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
          "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
          "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
          "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
          "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. ")
#: Licences held whole.
WHOLE: list[tuple[str, str]] = [
    ("MIT", TEMPLATES[4][1] + " The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
            "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
            "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
            "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
            "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", next(text for name, text in TEMPLATES if name == "ISC") + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS "
            "ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
            "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING "
            "FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR "
            "IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", _BSD + _AS_IS),
    ("BSD-3-Clause", _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission. " + _AS_IS),
]

#: Windows of one template that are compared at once.
WINDOW_ROWS = 512

#: Bytes outside words: ASCII other than letters and digits.
GAP = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _bigrams(words: np.ndarray) -> np.ndarray:
    """Hash of each word with its successor."""
    return mix64(words[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ words[1:])


class Templates:
    """Bigrams of all templates, and which template has which."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float, n_whole: int = 0):
        self.names, self.threshold = [name for name, _ in templates], threshold
        self.whole = np.arange(len(templates)) >= len(templates) - n_whole
        sets = []
        for _, text in templates:
            data = LOWER[np.frombuffer(text.encode(), np.uint8)]
            starts, ends, _ = word_bounds(data, np.array([0, len(data)]), GAP)
            sets.append(np.unique(_bigrams(hash_spans(data, starts, ends))))
        self.sizes = np.array([len(s) for s in sets])
        if not self.sizes.all():
            raise ValueError("a template needs two words")
        self.keys = np.unique(np.concatenate(sets))
        self.has = np.stack([np.isin(self.keys, s) for s in sets], axis=1).astype(np.int64)
        self.need = int(np.ceil(self.sizes * threshold / (2 - threshold) - 1e-9).min())
        self.most = int(np.floor(self.sizes * (2 - threshold) / threshold + 1e-9).max())

    def best(self, bigrams: np.ndarray, known: np.ndarray) -> tuple[float, int] | None:
        """Dice and template of the best match of one passage; ``known`` are places in ``keys`` or -1."""
        common = self.has[np.unique(known[known >= 0])].sum(axis=0)
        if common.max(initial=0) < self.need:
            return None
        size = len(np.unique(bigrams))
        if size > self.most:
            return None
        t = self.threshold
        fits = (size >= self.sizes * t / (2 - t) - 1e-9) & (size <= self.sizes * (2 - t) / t + 1e-9)
        dice = np.where(fits, 2.0 * common / (size + self.sizes), 0.0)
        top = int(np.where((dice >= t) & self.whole, dice + 1, dice).argmax())
        return (float(dice[top]), top) if dice[top] >= t else None


    def windows(self, bigrams: np.ndarray, known: np.ndarray, text: np.ndarray, skip) -> Iterator[tuple[int, float, int]]:
        """Text, Dice and template of windows that match; ``text`` is -1 for bigrams of no text."""
        t = self.threshold
        hits = np.flatnonzero((known >= 0) & (text >= 0))
        # Where the same bigram stood before: it is new in a window that begins after that.
        order = np.argsort(bigrams, kind="stable")
        before = np.full(len(bigrams), -1)
        again = bigrams[order[1:]] == bigrams[order[:-1]]
        before[order[1:][again]] = order[:-1][again]
        for k, size in enumerate(self.sizes.tolist()):
            need, most = int(np.ceil(size * t / (2 - t) - 1e-9)), int(np.floor(size * (2 - t) / t + 1e-9))
            at = hits[self.has[known[hits], k] > 0]
            if len(at) < need:
                continue
            first, last = at[:len(at) - need + 1], at[need - 1:]
            first = first[(last - first < most) & (text[first] == text[last])]
            first = first[np.array([not skip(i, k) for i in text[first].tolist()], bool)]
            inside = np.zeros(len(bigrams), bool)
            inside[at] = True
            top: dict[int, float] = {}
            for low in range(0, len(first), WINDOW_ROWS):
                start = first[low:low + WINDOW_ROWS, None]
                place = np.minimum(start + np.arange(most), len(bigrams) - 1)
                new = (before[place] < start) & (text[place] == text[start]) & (start + np.arange(most) < len(bigrams))
                shared = np.cumsum(new & inside[place], axis=1, dtype=np.int32)
                dice = 2.0 * shared / (np.cumsum(new, axis=1, dtype=np.int32) + size)
                for i, best in zip(text[start[:, 0]].tolist(), dice.max(axis=1).tolist()):
                    if best >= t and best > top.get(i, 0.0):
                        top[i] = best
            yield from ((i, dice, k) for i, dice in top.items())


def scan_block(data: np.ndarray, offsets: np.ndarray, templates: Templates) -> list[tuple[str | None, float, str | None]]:
    """Licence, Dice and scope of each text."""
    low_case = LOWER[data]
    starts, ends, at = word_bounds(low_case, offsets, GAP)
    n = len(offsets) - 1
    out: list[tuple[str | None, float, str | None]] = [(None, 0.0, None)] * n
    if len(starts) < 2:
        return out
    bigrams = _bigrams(hash_spans(low_case, starts, ends))
    place = np.searchsorted(templates.keys, bigrams)
    place[place == len(templates.keys)] = 0
    known = np.where(templates.keys[place] == bigrams, place, -1)
    # Bigrams that stay within a text, a paragraph, a line.
    step = np.diff(np.searchsorted(np.flatnonzero(data == 10), starts))
    text = np.repeat(np.arange(n), np.diff(at))
    same = text[1:] == text[:-1]
    joined = {"line": same & (step == 0), "paragraph": same & (step <= 1), "text": same}
    best: dict[int, tuple] = {}
    for order, scope in enumerate(SCOPES[:3]):
        inside = joined[scope]
        first = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
        last = np.flatnonzero(inside & ~np.append(inside[1:], False)) + 1
        hits = np.concatenate([[0], np.cumsum(known >= 0)])
        for a, b in zip(*(x[hits[last] - hits[first] >= templates.need] for x in (first, last))):
            found = templates.best(bigrams[a:b], known[a:b])
            if found:
                rank = (not templates.whole[found[1]], -found[0], found[1], order)
                i = int(text[a])
                best[i] = min(best.get(i, rank), rank)
    # What passages gave decides which windows are asked.
    settled = {i: rank[0] for i, rank in best.items()}
    asked = lambda i, k: i in settled and not (settled[i] and templates.whole[k])
    for i, dice, template in templates.windows(bigrams, known, np.where(same, text[1:], -1), asked):
        rank = (not templates.whole[template], -dice, template, len(SCOPES) - 1)
        best[i] = min(best.get(i, rank), rank)
    for i, (_, dice, template, order) in best.items():
        out[i] = (templates.names[template], -dice, SCOPES[order])
    return out


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = 0.8,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, license_id, dice, scope) of every row."""
    wanted = (Templates(TEMPLATES + NOTICES + WHOLE, threshold, len(WHOLE)) if templates is None
              else Templates(templates, threshold))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            data, offsets = arrow_text(batch.column(1))
            found = []
            for low, high in row_blocks(offsets):
                found += scan_block(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low], wanted)
            names, dice, scopes = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(dice, pa.float64()), pa.array(scopes, pa.string())],
                names=[id_col, "license_id", "dice", "scope"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, license_id string, dice double, scope string")
