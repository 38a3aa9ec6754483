"""Licence scans: texts against licence templates by the Dice coefficient of word bigrams.

Method: a text's scan units are its lines, its paragraphs (runs of lines with
words) and the whole text.  A unit's words are lower-cased and stripped of
punctuation; the score against a template is 2 |A and B| / (|A| + |B|) over the
sets of word bigrams.  A score of ``least`` or more needs sizes within a factor of
(2 - least) / least, so other templates are pruned by size before any score.

Licences that are no unit (a notice inside a line, a text of several paragraphs)
are found as spans: of each template that shares enough bigrams with a text, the
best run of words from each shared bigram, line ends ignored.  Of spans that
overlap the best stays, and a span goes when it overlaps a unit that scores as
much.  A template that differs from another licence's only in its end ("Licensed
under the ...") counts in a span only with the bigram that tells them apart.

Scale: no shuffle; a task reads blocks of about 4 MB of text.  Words are coded
once a block and only bigrams of template words are looked up.  The templates are
a parameter of fixed size, sent with the task.

Defined cases: null and empty texts have no unit and no match; a unit of one word
has no bigram.  Ties go to the template first in order of licence, then text.
Repeated rows and null ids are rows of their own; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tessera.llm.common import c
from tessera.llm.words import ALNUM, blocks, split_words

LEAST = 0.8

#: Licences and the names that notices call them by.
NAMES = {
    "0BSD": ("Zero-Clause BSD License", "BSD Zero Clause License"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC0-1.0": ("CC0 1.0", "Creative Commons Zero v1.0 Universal"),
    "EPL-2.0": ("Eclipse Public License, version 2.0", "Eclipse Public License 2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0"),
    "ISC": ("ISC License",),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0"),
    "MIT": ("MIT License",),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"),
    "Unlicense": ("Unlicense",),
    "Zlib": ("zlib License",),
}
#: What notices say around the name.
NOTICES = (
    "Licensed under {}", "Licensed under the {}", "Released under {}", "Released under the {}", "Distributed under the {}",
    "This work is licensed under {}", "This work is licensed under the {}", "This project is licensed under the terms of the {}",
    "This file is licensed under the {}", "Code is available under the {}", "Use of this source code is governed by the {}",
)
#: Short licence texts and headers.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.
IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising
from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may
obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under
the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the
Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You
can obtain one at https://mozilla.org/MPL/2.0/.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.
IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "AGPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published
by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be
useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License
for more details. You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered
by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to
permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement,
including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all
derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language
processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER
LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "CC0-1.0": """The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide
under copyright law, including all related and neighboring rights, to the extent allowed by law. You can copy, modify, distribute and perform the work, even for
commercial purposes, all without asking permission.""",
    "EPL-2.0": """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at
https://www.eclipse.org/legal/epl-2.0/""",
    "GPL-2.0": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free
Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but
WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street,
Fifth Floor, Boston, MA 02110-1301 USA.""",
    "LGPL-3.0": """This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the
Free Software Foundation, either version 3 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but
WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more
details. You should have received a copy of the GNU Lesser General Public License along with this library. If not, see <https://www.gnu.org/licenses/>.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this
software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize
copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the
benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all
present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR
OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE. For more information, please refer to <https://unlicense.org/>""",
}
_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific
prior written permission.
"""
TEXTS["BSD-3-Clause"] = TEXTS["BSD-2-Clause"].replace("THIS SOFTWARE IS PROVIDED", _THIRD + "THIS SOFTWARE IS PROVIDED")
_FSF = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
_FSF_2007 = f"Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> {_FSF}"
_CC = """Creative Commons {0} 4.0 International Public License By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and
conditions of this Creative Commons {0} 4.0 International Public License ("Public License")."""
#: How licences of many pages begin, and other forms of headers.
OPENINGS = (
    ("AGPL-3.0", f"GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 {_FSF_2007}"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("CC-BY-4.0", _CC.format("Attribution")),
    ("CC-BY-NC-4.0", _CC.format("Attribution-NonCommercial")),
    ("CC-BY-SA-4.0", _CC.format("Attribution-ShareAlike")),
    ("CC0-1.0", "has waived all copyright and related or neighboring rights to this work"),
    ("CC0-1.0", "CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES. DISTRIBUTION OF THIS DOCUMENT DOES NOT CREATE AN ATTORNEY-CLIENT RELATIONSHIP."),
    ("EPL-2.0", """Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE ("AGREEMENT"). ANY USE, REPRODUCTION
OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT."""),
    ("GPL-2.0", f"GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA {_FSF}"),
    ("GPL-2.0", TEXTS["GPL-3.0"].replace("version 3", "version 2")),
    ("GPL-3.0", f"GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 {_FSF_2007}"),
    ("LGPL-3.0", f"GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 {_FSF_2007}"),
    ("LGPL-3.0", TEXTS["LGPL-3.0"].replace("library", "program")),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *((k, f"SPDX-License-Identifier: {k}") for k in NAMES),
    *((k, f"SPDX-License-Identifier: {k}-{end}") for k in NAMES if "GPL" in k for end in ("only", "or-later")),
)


def default_templates() -> list[tuple[str, str]]:
    """(licence, text) of all notices, short texts and openings."""
    notices = [(k, form.format(name)) for k, names in NAMES.items() for name in names for form in NOTICES]
    return sorted({*notices, *TEXTS.items(), *OPENINGS})


@dataclass
class Templates:
    """Word-bigram sets of the templates, as an inverted index."""

    names: list[str]
    vocabulary: pa.Array
    codes: np.ndarray  # bigrams of any template, sorted
    starts: np.ndarray  # per bigram its templates ``holders[starts[k]:starts[k + 1]]``
    holders: np.ndarray
    sizes: np.ndarray  # bigrams per template
    telling: np.ndarray  # per template the place in ``codes`` a span must have, or -1

    @classmethod
    def of(cls, templates: list[tuple[str, str]]) -> Templates:
        words = split_words(pa.array([t for _, t in templates], pa.large_string()), ALNUM, lower=True)
        codes, vocabulary = words.codes()
        row = words.row_of()
        pair = np.flatnonzero(row[1:] == row[:-1])
        held = np.unique(np.stack([codes[pair].astype(np.int64) * len(vocabulary) + codes[pair + 1], row[pair]], axis=1), axis=0)
        bigrams, starts = np.unique(held[:, 0], return_index=True)
        names = [k for k, _ in templates]
        telling = np.full(len(names), -1)
        texts = [codes[a:b].tolist() for a, b in zip(words.rows[:-1], words.rows[1:], strict=True)]
        order = sorted(range(len(names)), key=lambda x: texts[x])
        for i, x in enumerate(order):
            # The longest common beginning with another licence's template is a neighbour's.
            common = 0
            for others in (reversed(order[:i]), order[i + 1 :]):
                other = next((y for y in others if names[y] != names[x]), None)
                if other is not None:
                    common = max(common, next((k for k, (a, b) in enumerate(zip(texts[x], texts[other], strict=False)) if a != b), min(len(texts[x]), len(texts[other]))))
            if 0 < common < len(texts[x]) <= 2 * common:
                telling[x] = np.searchsorted(bigrams, texts[x][common - 1] * len(vocabulary) + texts[x][common])
        return cls(names, vocabulary, bigrams, np.append(starts, len(held)), held[:, 1], np.bincount(held[:, 1], minlength=len(templates)), telling)


def _units(start: np.ndarray, row: np.ndarray, newlines: np.ndarray) -> list[tuple[str, np.ndarray]]:
    """Per kind of unit the number of each word's unit."""
    line = np.searchsorted(newlines, start)
    new_row = np.concatenate([[False], row[1:] != row[:-1]])
    gap = np.diff(line, prepend=line[:1])
    return [
        ("line", np.cumsum(new_row | (gap > 0))),
        ("paragraph", np.cumsum(new_row | (gap > 1))),
        ("text", np.cumsum(new_row)),
    ]


def _best_end(own: list[int], a: int, places: dict[int, int], size: int, telling: int, least: float) -> tuple[float, int] | None:
    """Score and last bigram of the best span from bigram ``a``; ``places`` are the bigrams of the template."""
    best, seen, shared, told = None, set(), 0, telling < 0
    for p in range(a, len(own)):
        code = places.get(p)
        if own[p] not in seen:
            seen.add(own[p])
            if len(seen) > size * (2 - least) / least + 1e-9:
                break
            shared += code is not None
        if code is not None:
            told = told or code == telling
            score = 2 * shared / (len(seen) + size)
            if told and score >= least and (best is None or score > best[0]):
                best = score, p
    return best


def _spans(t: Templates, least: float, own: np.ndarray, at: np.ndarray, row: np.ndarray, rows: np.ndarray, units: list[tuple]) -> list[tuple[int, str, int, int, int, float]]:
    """Runs of words that match a template better than the units they overlap."""
    place = np.flatnonzero((at >= 0) & (row[1:] == row[:-1]))
    k = at[place]
    n = t.starts[k + 1] - t.starts[k]
    template = t.holders[np.repeat(t.starts[k] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
    key, place = np.repeat(row[place], n) * len(t.names) + template, np.repeat(place, n)
    # A span shares least / (2 - least) of its template, so its text does.
    pairs = np.unique(np.stack([key, at[place]], axis=1), axis=0)
    keys, shared = np.unique(pairs[:, 0], return_counts=True)
    keys = keys[shared >= t.sizes[keys % len(t.names)] * least / (2 - least) - 1e-9]
    chosen = np.isin(key, keys)
    key, place = key[chosen], place[chosen]
    order = np.lexsort((place, key))
    key, place = key[order], place[order]
    found: dict[int, list[tuple]] = {}
    bigrams: dict[int, list[int]] = {}
    for x, a, b in zip(keys.tolist(), np.searchsorted(key, keys).tolist(), np.searchsorted(key, keys, side="right").tolist(), strict=True):
        r, j = divmod(x, len(t.names))
        first = int(rows[r])
        if r not in bigrams:
            bigrams[r] = own[first : int(rows[r + 1]) - 1].tolist()
        places = dict(zip((place[a:b] - first).tolist(), at[place[a:b]].tolist(), strict=True))
        for p in places:
            best = _best_end(bigrams[r], p, places, int(t.sizes[j]), int(t.telling[j]), least)
            if best:
                found.setdefault(r, []).append((-best[0], p - best[1], p, j))
    taken: dict[int, list[tuple]] = {}
    for r, _, a, n_words, _, score in units:
        taken.setdefault(r, []).append((a, a + n_words, score))
    out = []
    for r, options in found.items():
        kept = taken.get(r, [])
        own_spans: list[tuple] = []
        for score, minus, a, j in sorted(options):
            b = a - minus + 2  # the word after the last bigram
            if not any(a < d and c_ < b for c_, d in own_spans) and not any(a < d and c_ < b and have >= -score - 1e-12 for c_, d, have in kept):
                own_spans.append((a, b))
                out.append((r, "span", a, b - a, j, -score))
    return out


def scan_block(texts: pa.Array, t: Templates, least: float) -> list[tuple[int, str, int, int, int, float]]:
    """(row, kind, first word in the row, words, template, score) of each matching unit's best template, and of spans."""
    words = split_words(texts, ALNUM, lower=True)
    if not len(words.start):
        return []
    codes, vocabulary = words.codes()
    known = np.asarray(pc.index_in(vocabulary, t.vocabulary).fill_null(-1)).astype(np.int64)[codes]
    row = words.row_of()
    pair = known[:-1] * len(t.vocabulary) + known[1:]
    at = np.minimum(np.searchsorted(t.codes, pair), len(t.codes) - 1)
    hit = (known[:-1] >= 0) & (known[1:] >= 0) & (t.codes[at] == pair)
    own = codes[:-1].astype(np.int64) * len(vocabulary) + codes[1:]
    newlines = np.flatnonzero(words.data == 0x0A)
    factor = (2 - least) / least
    out, seen = [], set()
    for kind, unit in _units(words.start, row, newlines):
        inside = unit[1:] == unit[:-1]
        n_units = int(unit[-1]) + 1
        hits = np.bincount(unit[1:][hit & inside], minlength=n_units)
        # A match of score ``least`` shares least / (2 - least) of the smallest template at least.
        open_units = hits >= t.sizes.min() / factor - 1e-9
        pick = np.flatnonzero(inside & open_units[unit[1:]])
        if not len(pick):
            continue
        u = unit[pick]
        sets, one = np.unique(np.stack([u, own[pick]], axis=1), axis=0, return_index=True)
        size = np.bincount(sets[:, 0], minlength=n_units)
        pick = pick[one]
        shared = pick[hit[pick]]
        k = at[shared]
        n = t.starts[k + 1] - t.starts[k]
        template = t.holders[np.repeat(t.starts[k] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        whose = np.repeat(unit[shared], n)
        near = (size[whose] <= factor * t.sizes[template] + 1e-9) & (size[whose] >= t.sizes[template] / factor - 1e-9)
        both, common = np.unique(whose[near] * len(t.names) + template[near], return_counts=True)
        whose, template = both // len(t.names), both % len(t.names)
        dice = 2 * common / (size[whose] + t.sizes[template])
        order = np.lexsort((template, -dice, whose))
        order = order[np.concatenate([[True], whose[order][1:] != whose[order][:-1]])] if len(order) else order
        first = np.searchsorted(unit, np.arange(n_units + 1))
        for i in order[dice[order] >= least].tolist():
            a, b = int(first[whose[i]]), int(first[whose[i] + 1])
            if (a, b) not in seen:  # a paragraph of one line is that line
                seen.add((a, b))
                r = int(row[a])
                out.append((r, kind, a - int(words.rows[r]), b - a, int(template[i]), float(dice[i])))
    return sorted(out + _spans(t, least, own, np.where(hit, at, -1), row, words.rows, out))


SCHEMA = "doc_id long, n_words long, matches array<struct<unit:string,first_word:long,n_words:long,license:string,dice:double>>, spans array<struct<unit:string,first_word:long,n_words:long,license:string,dice:double>>"
_MATCH = pa.struct([("unit", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("license", pa.string()), ("dice", pa.float64())])


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] | None = None, least: float = LEAST) -> DataFrame:
    """Per row: doc_id, n_words, and the units and the spans that match a template, in text order."""
    chosen = sorted(default_templates() if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Templates.of(chosen)
        for batch in blocks(batches, "text"):
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for r, kind, first, n, template, dice in scan_block(batch.column("text"), t, least):
                (spans if kind == "span" else found)[r].append({"unit": kind, "first_word": first, "n_words": n, "license": t.names[template], "dice": dice})
            for x in found + spans:
                x.sort(key=lambda m: (m["first_word"], m["n_words"]))
            n_words = np.diff(split_words(batch.column("text"), ALNUM, lower=True).rows)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n_words, pa.int64()), pa.array(found, pa.list_(_MATCH)), pa.array(spans, pa.list_(_MATCH))], names=["doc_id", "n_words", "matches", "spans"])

    return docs.select(c(id_col).cast("long").alias("id"), c(text).alias("text")).mapInArrow(run, SCHEMA)
