"""Licence scans: Dice coefficient over word bigrams against templates."""

from __future__ import annotations

from collections.abc import Iterator
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larchfield.llm.common import batches_of
from larchfield.llm.hashing import mix, word_hashes, word_spans

DICE = 0.85

# Wordings shared by the BSD licences.
BSD_CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: 1. Redistributions of source code "
    "must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission. "
)
BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR '
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
    "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
    "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

# Licence notices as their licences word them, by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
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
        "DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("BSD-2-Clause", BSD_CLAUSES + BSD_DISCLAIMER),
    ("BSD-3-Clause", BSD_CLAUSES + BSD_NAMES + BSD_DISCLAIMER),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        'notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL '
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU Affero General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation; either version 2 of "
        "the License, or (at your option) any later version.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def all_templates() -> list[tuple[str, str]]:
    """The notices, and the full wording of the licences in ``texts``."""
    folder = resources.files("larchfield.llm") / "texts"
    files = sorted((f for f in folder.iterdir() if f.name.endswith(".txt")), key=lambda f: f.name)
    return TEMPLATES + [(f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in files]


def bigrams(words: np.ndarray) -> np.ndarray:
    """Hashes of consecutive word pairs."""
    return mix(words[:-1] * np.uint64(3) ^ mix(words[1:]))


class Templates:
    """Bigrams of all templates as sorted arrays, in order of their number."""

    def __init__(self, templates: list[tuple[str, str]]) -> None:
        made = [(np.sort(bigrams(word_hashes(pa.array([t]))[0])), name) for name, t in templates]
        made = sorted((m for m in made if len(m[0])), key=lambda m: len(m[0]))
        self.grams = [m[0] for m in made]
        self.names = [m[1] for m in made]
        self.sizes = np.array([len(g) for g in self.grams], np.int64)
        self.known = np.unique(np.concatenate(self.grams)) if made else np.zeros(0, np.uint64)

    def best(self, grams: np.ndarray) -> tuple[str, float] | None:
        """The template of highest Dice coefficient, if that is enough; ties to the first name.

        Dice is at most 2 min / (n + m), so only templates whose number of bigrams
        lies within the bounds are compared.
        """
        size = len(grams)
        low = np.searchsorted(self.sizes, np.ceil(size * DICE / (2 - DICE) - 1e-9))
        high = np.searchsorted(self.sizes, np.floor(size * (2 - DICE) / DICE + 1e-9), side="right")
        values, counts = np.unique(grams, return_counts=True)
        found = []
        for at in range(low, high):
            own, own_counts = np.unique(self.grams[at], return_counts=True)
            _, a, b = np.intersect1d(values, own, assume_unique=True, return_indices=True)
            dice = 2 * np.minimum(counts[a], own_counts[b]).sum() / (size + self.sizes[at])
            if dice >= DICE:
                found.append((-float(dice), self.names[at]))
        return (min(found)[1], -min(found)[0]) if found else None


    def windows(self, grams: np.ndarray, edges: np.ndarray) -> list[tuple[int, int, str, float]]:
        """(first bigram, end, licence, dice) of windows that match a template.

        Windows slide over every bigram of a row, in sizes from 0.74 to 1.35 times
        the template's in steps of 5 % (of one bigram for small templates). ``edges``
        tells where rows begin. An accepted window has at least 0.739 of the template's
        bigrams within the largest size, so only such spots are looked at.
        """
        at = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
        hits = np.flatnonzero(self.known[at] == grams)
        member, out = np.zeros(len(self.known), bool), []
        for number, size in enumerate(self.sizes.tolist()):
            small = int(np.ceil(size * DICE / (2 - DICE) - 1e-9))
            large = int(size * (2 - DICE) / DICE + 1e-9)
            least = int(np.ceil(DICE * (size + small) / 2 - 1e-9))
            member[:] = False
            member[np.searchsorted(self.known, self.grams[number])] = True
            own = hits[member[at[hits]]]
            ends = own[least - 1 :]
            near = np.flatnonzero(ends - own[: len(ends)] < large)
            if not len(near):
                continue
            # Spots that meet are one stretch; none reaches into the next row.
            first, last = own[near] - large, ends[near] + large
            cuts = np.flatnonzero(np.append(True, first[1:] > np.maximum.accumulate(last)[:-1]))
            for a, b in zip(first[cuts], np.maximum.accumulate(last)[np.append(cuts[1:], len(last)) - 1], strict=True):
                a, b = max(int(a), 0), min(int(b), len(grams))
                places = [a, *edges[(edges > a) & (edges < b)].tolist(), b]
                for x, y in zip(places[:-1], places[1:], strict=True):
                    out += self.best_windows(grams, x, y, number, small, large)
        return out

    def best_windows(
        self, grams: np.ndarray, start: int, stop: int, number: int, small: int, large: int
    ) -> list[tuple[int, int, str, float]]:
        """Disjoint windows of one template in a stretch, the best first."""
        own, size = self.grams[number], int(self.sizes[number])
        values, own_counts = np.unique(own, return_counts=True)
        counted = np.concatenate([[0], np.cumsum(np.isin(grams[start:stop], values))])
        spots = []
        for width in sorted({*range(small, large + 1, max(1, size // 20)), size}):
            if width < len(counted):
                bound = 2 * (counted[width:] - counted[:-width]) / (width + size)
                at = np.flatnonzero(bound >= DICE)
                spots += zip((-bound[at]).tolist(), at.tolist(), [width] * len(at))
        out, taken = [], np.zeros(stop - start + 1, bool)
        for _, at, width in sorted(spots):
            if taken[at : at + width].any():
                continue
            found, counts = np.unique(grams[start + at : start + at + width], return_counts=True)
            _, a, b = np.intersect1d(found, values, assume_unique=True, return_indices=True)
            dice = 2 * np.minimum(counts[a], own_counts[b]).sum() / (width + size)
            if dice >= DICE:
                taken[at : at + width] = True
                out.append((start + at, start + at + width, self.names[number], float(dice)))
        return out


def blocks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, the row and line of each, its paragraph, and row bounds.

    Lines end at line feeds; paragraphs are parted by lines that are empty or
    hold only spaces, tabs and carriage returns.
    """
    words, bounds, data, offsets, starts = word_spans(texts)
    feeds = np.flatnonzero(data == 10)
    row = np.searchsorted(offsets, starts, side="right") - 1
    line = np.searchsorted(feeds, starts) + row
    filled = np.concatenate([[0], np.cumsum(~np.isin(data, [9, 10, 13, 32]))])
    blank = feeds[1:][filled[feeds[1:]] == filled[feeds[:-1]]]
    paragraph = np.searchsorted(blank, starts) + row
    return words, row, line, paragraph, bounds


def runs(label: np.ndarray) -> np.ndarray:
    """Where runs of one label begin, with the end."""
    if not len(label):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(label[1:] != label[:-1]) + 1, [len(label)]])


def scan(texts: pa.Array, templates: Templates) -> list[tuple[int, str, str, int, float]]:
    """(row, licence, unit, first line, dice) of all units that match a template."""
    words, row, line, paragraph, bounds = blocks(texts)
    if len(words) < 2 or not len(templates.sizes):
        return []
    grams = bigrams(words)
    known = np.isin(grams, templates.known)
    counted = np.concatenate([[0], np.cumsum(known)])
    first_line = line[np.minimum(bounds[:-1], len(words) - 1)]
    least = int(np.ceil(templates.sizes[0] * DICE / (2 - DICE) - 1e-9))
    most = int(templates.sizes[-1] * (2 - DICE) / DICE + 1e-9)
    out, seen, held = [], set(), {}
    for unit, label in (("line", line), ("paragraph", paragraph), ("text", row)):
        edges = runs(label)
        begin, size = edges[:-1], np.diff(edges) - 1
        shared = counted[begin + np.maximum(size, 0)] - counted[begin]
        # Shared bigrams bound the coefficient from above for any template.
        open_units = (size >= least) & (size <= most) & (2 * shared >= DICE * (size + least))
        for at in np.flatnonzero(open_units):
            a, b = int(begin[at]), int(begin[at] + size[at])
            if (a, b) in seen:
                continue
            seen.add((a, b))
            best = templates.best(grams[a:b])
            if best:
                out.append((int(row[a]), best[0], unit, int(line[a] - first_line[row[a]]), best[1]))
                held.setdefault(int(row[a]), []).append((a, b, best[0]))
    # Row ends: the bigram over two rows belongs to none.
    within = np.where(row[1:] == row[:-1], grams, np.uint64(0))
    for a, b, name, dice in sorted(templates.windows(within, bounds), key=lambda w: (-w[3], w[0] - w[1], w)):
        r = int(row[a])
        others = held.setdefault(r, [])
        if all(2 * (min(b, y) - max(a, x)) <= min(b - a, y - x) or y - x < (b - a) / 2 for x, y, _ in others):
            out.append((r, name, "window", int(line[a] - first_line[r]), dice))
            others.append((a, b, name))
    return out


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """Licence notices in documents: doc_id, license, unit, line and dice.

    Every line, every paragraph (between blank lines) and every whole text is a
    unit; windows of words of each template's size slide over the whole text, and
    one that no unit found covers by half is a unit ``window``. Text is normalised to lower-case words; the Dice coefficient counts
    word bigrams with their multiplicity. A unit gets the template of the highest
    coefficient if that is 0.85 or more; ties go to the first name. A unit that
    spans the same words as a smaller one is not reported again. ``line`` counts
    the lines from the text's first word, from 0.

    One row per unit found. Null and empty texts and units of one word have no
    rows; lines, paragraphs and texts beyond the size bounds of all templates are
    searched by windows; repeated
    rows are reported each; a null doc_id is carried along; an empty table gives
    no rows. Other columns are ignored. Templates travel with the code: notices and
    the full wording of the licences in ``texts``.
    """
    wanted = Templates(all_templates() if templates is None else templates)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "text"):
            found = scan(batch.column("text"), wanted)
            ids = batch.column("doc_id").take(pa.array([f[0] for f in found], pa.int64()))
            fields = [list(x) for x in zip(*found, strict=True)] if found else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(fields[1], pa.string()),
                    pa.array(fields[2], pa.string()),
                    pa.array(fields[3], pa.int64()),
                    pa.array(fields[4], pa.float64()),
                ],
                ["doc_id", "license", "unit", "line", "dice"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(find, "doc_id long, license string, unit string, line long, dice double")
