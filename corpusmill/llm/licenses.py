"""License scan: winnowed fingerprints of templates in an inverted index, then banded sequence alignment.

Templates are cut into words; hashes of GRAM words in a row are winnowed (the least hash of every WINDOW neighbours is
kept) and posted in an inverted index: fingerprint -> (template, place). The index is a few thousand entries, fixed by
the templates, and goes to every task. A text's fingerprints are winnowed the same way, so a shared passage of GRAM +
WINDOW - 1 words always shares one. Every diagonal (place in the text less place in the template) that a hit lies on is a
candidate, and a banded alignment of the template's words against the text's words around it gives the matched words, the
coverage and the span. Candidates of a template are aligned side by side; those that match word for word need no table.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import bound_batches, read_table
from corpusmill.llm.kernels import LOWER, hash_spans, runs_of, shingle_hashes, slices, text_buffer

GRAM, WINDOW = 3, 2
#: Diagonals on either side of a hit that the alignment explores.
BAND = 12
#: Matched words over template words from which a match is reported; templates of few words must match whole, as one
#: word names the license.
COVERAGE, SHORT = 0.8, 15

# Public license notices and texts.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "MIT-line": "Released under the MIT License.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
        'http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "MIT": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
        '"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above "
        "copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
        "the documentation and/or other materials provided with the distribution."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
    "MIT-whole": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
        '"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE '
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
        "OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC-whole": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE '
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
        "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD-2-Clause-whole": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above "
        "copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
        'the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
        "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
        "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
        "THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above "
        "copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
        "the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        'from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone "
        "to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be "
        "misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. "
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
    ),
    "BSL-1.0": (
        'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, '
        "display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the "
        "following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, "
        "in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor."
    ),
    "LGPL-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
        "License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR "
        "A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "AGPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR "
        "A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."
    ),
}

_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = True
_IS_WORD[128:] = True


def _words(column: pa.Array):
    """Lower-case runs of letters, digits and characters beyond ASCII: hashes, first word of each text, starts, ends, bytes, text offsets."""
    data, offsets = text_buffer(column)
    data = LOWER[data]
    starts, ends = runs_of(_IS_WORD[data], offsets)
    return hash_spans(data, starts, ends), np.searchsorted(starts, offsets), starts, ends, data, offsets


def winnow(grams: np.ndarray) -> np.ndarray:
    """Places of the kept grams: the rightmost least hash of every WINDOW neighbours (all of them if there are fewer)."""
    if len(grams) <= WINDOW:
        return np.arange(len(grams)) if len(grams) <= 1 else np.array([int(len(grams) - 1 - np.argmin(grams[::-1]))])
    views = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
    return np.unique(np.arange(len(views)) + WINDOW - 1 - np.argmin(views[:, ::-1], axis=1))


class TemplateIndex:
    """The inverted index of the templates' winnowed fingerprints."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        hashes, first, *_ = _words(pa.array(list(templates.values())))
        self.words = [hashes[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        posts = defaultdict(list)
        for t, own in enumerate(self.words):
            grams = shingle_hashes(own, GRAM)
            for place in winnow(grams):
                posts[int(grams[place])].append((t, int(place)))
        self.posts = dict(posts)
        self.sorted = np.array(sorted(posts), np.uint64)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.sorted >> np.uint64(48)).astype(np.int64)] = True


def align_all(template: np.ndarray, text: np.ndarray, diagonals: np.ndarray, band: int = BAND) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Banded alignments of all template words with text words near each diagonal (text place - template place), side by side.

    Returns (matched words, first and last matched text word) by diagonal: the most matches with the fewest words left out
    between; 0 matched words have no span.
    """
    n, width, many = len(template), 2 * band + 1, len(diagonals)
    shift, rows = np.arange(width) - band, np.arange(many)
    gap = 0.01 * np.arange(width)
    best, back = np.zeros((many, width)), np.zeros((n, many, width), np.int8)
    for i in range(n):
        at = diagonals[:, None] + (shift + i)[None, :]  # the text word that meets template word i
        inside = (at >= 0) & (at < len(text))
        same = inside & (text[np.clip(at, 0, len(text) - 1)] == template[i])
        hit = np.where(same, best + 1.0, -1e9)
        skip = np.concatenate([best[:, 1:] - 0.01, np.full((many, 1), -1e9)], axis=1)  # a template word that the text lacks
        now = np.maximum(hit, skip)
        # Text words that the template lacks: the best of all places to the left, less what lies between.
        through = np.maximum.accumulate(now + gap, axis=1) - gap
        back[i] = np.where(through > now + 1e-6, 3, np.where(hit >= skip, 1, 2))
        best = through
    i, k = np.full(many, n - 1), best.argmax(axis=1)
    matched, first, last = np.zeros(many, np.int64), np.zeros(many, np.int64), np.zeros(many, np.int64)
    going = rows
    while len(going):
        step, at = back[i[going], going, k[going]], diagonals[going] + shift[k[going]] + i[going]
        hits = going[step == 1]
        last[hits] = np.where(matched[hits] == 0, at[step == 1], last[hits])
        first[hits] = at[step == 1]
        matched[hits] += 1
        k[going] += np.where(step == 2, 1, np.where(step == 3, -1, 0))
        i[going] -= step != 3
        going = going[i[going] >= 0]
    return matched, first, last


def align(template: np.ndarray, text: np.ndarray, diagonal: int, band: int = BAND) -> tuple[int, int, int]:
    """align_all along one diagonal."""
    if not len(text):
        return 0, 0, 0
    matched, first, last = align_all(template, text, np.array([diagonal]), band)
    return int(matched[0]), int(first[0]), int(last[0])


def _aligned(template: np.ndarray, text: np.ndarray, diagonals: np.ndarray, least: float) -> Iterator[tuple[int, int, int]]:
    """(matched, first, last) of the diagonals that may reach `least` matched words. What matches word for word needs no
    table, and no more words can match than the text around a diagonal has of the template's."""
    n = len(template)
    fits = diagonals[(diagonals >= 0) & (diagonals + n <= len(text))]
    whole = np.zeros(0, np.int64)
    for k in range(0, len(fits), step := max(1, (1 << 18) // n)):
        part = fits[k : k + step]
        whole = np.r_[whole, part[(text[part[:, None] + np.arange(n)] == template).all(axis=1)]]
    yield from ((n, int(d), int(d) + n - 1) for d in whole)
    around = ((d, text[max(0, d - BAND) : max(0, d + n + BAND)]) for d in np.setdiff1d(diagonals, whole).tolist())
    rest = np.array([d for d, near in around if len(near) >= least and np.isin(template, near).sum() >= least], np.int64)
    for k in range(0, len(rest), step := max(1, (1 << 20) // (n * (2 * BAND + 1)))):
        yield from zip(*(x.tolist() for x in align_all(template, text, rest[k : k + step])), strict=True)


def match_words(text: np.ndarray, grams: np.ndarray, index: TemplateIndex, coverage: float) -> list[tuple[int, int, int, int]]:
    """(template, first word, last word, matched) of a text's license passages."""
    if not len(grams):
        return []
    hits = np.flatnonzero(index.maybe[(grams >> np.uint64(48)).astype(np.int64)])
    hits = hits[np.isin(grams[hits], index.sorted)] if len(hits) else hits
    if not len(hits):
        return []
    # A text is only winnowed around its hits: a gram is kept if it is the least of a window that holds it.
    kept = []
    for h in hits.tolist():
        low = max(0, h - WINDOW + 1)
        near = grams[low : h + WINDOW]
        kept.append(len(grams) <= WINDOW or any(grams[h] == near[a : a + WINDOW].min() for a in range(len(near) - WINDOW + 1) if a <= h - low < a + WINDOW))
    regions = defaultdict(list)
    for h, good in zip(hits.tolist(), kept, strict=True):
        if good:
            for t, place in index.posts[int(grams[h])]:
                regions[t].append(h - place)
    found = set()
    for t, diagonals in regions.items():
        template = index.words[t]
        least = (coverage if len(template) > SHORT else 1.0) * len(template)
        found |= {(t, first, last, matched) for matched, first, last in _aligned(template, text, np.unique(diagonals), least) if matched >= least}
    # Of overlapping matches the one with the most matched words stays, then the one in the fewest text words.
    out = []
    for own in sorted(found, key=lambda x: (-x[3], x[2] - x[1], x[1], x[0])):
        at = bisect.bisect_left(out, (own[1],))
        if (not at or out[at - 1][2] < own[1]) and (at == len(out) or out[at][0] > own[2]):
            out.insert(at, (own[1], own[0], own[2], own[3]))
    return [(t, first, last, matched) for first, t, last, matched in out]


def _scan(templates: dict[str, str], coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TemplateIndex(templates)
        for batch in batches:
            rows = []
            for low, high in slices(batch.column("text")):
                hashes, first, starts, ends, data, offsets = _words(batch.column("text").slice(low, high - low))
                grams = shingle_hashes(hashes, GRAM)
                maybe = index.maybe[(grams >> np.uint64(48)).astype(np.int64)]
                some = np.unique(np.searchsorted(first, np.flatnonzero(maybe), "right") - 1) if len(grams) else []
                for r in some:
                    a, b = first[r], first[r + 1]
                    if b - a < GRAM:
                        continue
                    passages = match_words(hashes[a:b], grams[a : b - GRAM + 1], index, coverage)
                    # Code points before each byte of the text: those that begin one.
                    points = np.r_[0, np.cumsum((data[offsets[r] : offsets[r + 1]] & 0xC0) != 0x80)] if passages else ()
                    for t, w0, w1, matched in passages:
                        span = (int(points[x - offsets[r]]) for x in (starts[a + w0], ends[a + w1]))
                        rows.append((low + int(r), index.names[t], *span, matched, len(index.words[t])))
            column = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(column[0], pa.int64())), pa.array(column[1], pa.string()), *(pa.array(c, pa.int64()) for c in column[2:])], ["id", "license", "start", "end", "matched_words", "template_words"]
            )

    return run


def find_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """License passages: id_col, license, start, end (code points, end exclusive), matched_words, template_words, coverage.

    One row per passage, however often a text holds a template; texts without one, null and empty texts have no row. Of
    overlapping passages the one with the most matched words stays, then the shortest, then the first template. Repeated rows and null ids are rows like others; an empty table
    gives no rows. Other columns play no part.
    """
    bound_batches(df.sparkSession)
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    out = docs.mapInArrow(_scan(templates or TEMPLATES, coverage), f"id {kind}, license string, start long, end long, matched_words long, template_words long")
    return out.select(F.col("id").alias(id_col), "license", "start", "end", "matched_words", "template_words", F.round(F.col("matched_words") / F.col("template_words"), 4).alias("coverage"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """find_licenses over all rows and whole texts of documents."""
    return find_licenses(read_table(spark, sf_dir, "documents"))
