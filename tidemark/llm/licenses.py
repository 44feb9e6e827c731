"""Operator 7: licence scan by Dice coefficient over word bigrams.

A text is normalised (lower case; words are runs of letters and digits; a copyright notice's line loses its
years and names) and compared to licence templates: Dice = 2 |A and B| / (|A| + |B|) over the sets of word bigrams. Compared are
the text's blocks: each line, each paragraph (lines between blank lines), each run of consecutive paragraphs and the whole text, so a
notice is found whether it stands alone, in a file's header, in several paragraphs of a longer document or as the document itself.
Since |A and B| <= min(|A|, |B|), a block of b bigrams can only reach ``threshold`` t with templates of between b t/(2-t) and
b (2-t)/t bigrams; the other templates are never looked at. A text that lacks that share of every template's bigrams has no such
block and is not cut into blocks at all; runs of paragraphs start where a bigram of a possible template is and grow to its bound.
Candidates are counted through an index from bigram to templates.

A licence is named only if the words that tell it from its neighbours agree: a block with "GNU Lesser", "NonCommercial", "endorse or" and
the like, or with other version numbers, than the template is not that licence, and a full text needs its title. Covered are the licences
in ``TEMPLATES`` and ``license_texts``; a licence that is in neither is not found.

Edge cases: NULL and empty texts have no block and no licence; a block of one word has no bigram and matches nothing;
ties go to the longer template, then to the first name; repeated rows are scanned each; an empty
table gives no row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship
from tidemark.llm.license_texts import FULL_TEXTS

THRESHOLD = 0.8
WORD = re.compile(r"[^\W_]+")
PARAGRAPHS = re.compile(r"\n[ \t\r\f\v]*\n")
COPYRIGHT = re.compile(r"^\W*(copyright\b|\(c\)|©)(?!.*\blicen[sc]e\b).*$", re.I | re.M)

# Public licence texts and the notices that stand for them, by SPDX identifier.
TEMPLATES = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
        "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
        DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
        NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
        ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
        LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
        CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
        SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
        ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
        LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
        CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
        SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program. If not, see
        https://www.gnu.org/licenses/."""),
    ("GPL-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program; if not, write to the
        Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."""),
    ("LGPL-3.0", """This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
        the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for
        more details. You should have received a copy of the GNU Lesser General Public License along with this library. If not,
        see https://www.gnu.org/licenses/."""),
    ("LGPL-2.1", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your
        option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public
        License for more details. You should have received a copy of the GNU Lesser General Public License along with this library;
        if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."""),
    ("AGPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
        the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for
        more details. You should have received a copy of the GNU Affero General Public License along with this program. If not,
        see https://www.gnu.org/licenses/."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means."""),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("all-rights-reserved", "All rights reserved."),
)

# Word pairs that tell a licence from its neighbours: a block with one that a template lacks is not that template's.
MARKS = {("gnu", "lesser"), ("gnu", "library"), ("gnu", "affero"), ("endorse", "or"), ("by", "sa"), ("by", "nc"), ("by", "nd"), ("nc", "sa"), ("nc", "nd"),
         *((a, b) for a in ("attribution", "noncommercial") for b in ("noncommercial", "sharealike", "noderivatives"))}
VERSIONED = {"version", "v", "by", "sa", "nc", "nd", "attribution", "sharealike", "noncommercial", "noderivatives"}


def bigrams(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:]))


def normalised_words(text: str) -> list[str]:
    return WORD.findall(COPYRIGHT.sub("copyright", text).lower() if COPYRIGHT.search(text) else text.lower())


def dice(a: set, b: set) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def versions(words: list[str]) -> set[tuple[str, ...]]:
    """Version numbers that follow the word "version" or a family name (2.0 is 2)."""
    out = set()
    for k in range(1, len(words)):
        if words[k - 1] in VERSIONED and words[k].isdigit():
            minor = words[k + 1:k + 2]
            out.add((words[k], *minor) if minor and minor[0].isdigit() and minor[0] != "0" else (words[k],))
    return out


class Template(NamedTuple):
    name: str
    size: int
    marks: set
    versions: set
    title: str


@cache
def template_index(threshold: float) -> tuple[list[Template], dict[tuple[str, str], list[int]], int, int]:
    """Templates, bigram -> templates, and the smallest and largest block that can match one."""
    index, templates = defaultdict(list), []
    for name, title, text in [*((n, "", t) for n, t in TEMPLATES), *FULL_TEXTS]:
        words = normalised_words(text)
        grams = bigrams(words)
        templates.append(Template(name, len(grams), MARKS & grams, versions(words), f" {' '.join(normalised_words(title))} " if title else ""))
        for g in grams:
            index[g].append(len(templates) - 1)
    sizes = [t.size for t in templates]
    return templates, dict(index), int(min(sizes) * threshold / (2 - threshold) + 1e-9), int(max(sizes) * (2 - threshold) / threshold) + 1


def agrees(template: Template, words: list[str], grams: set) -> bool:
    """Do family words, version and (of a full text) the title speak for the template?"""
    if not MARKS & grams <= template.marks or template.title and template.title not in f" {' '.join(words)} ":
        return False
    return not template.versions or not (own := versions(words)) or bool(own & template.versions)


def best_of(found: dict[int, int], words: list[str], grams: set, threshold: float) -> tuple[float, str, int, bool] | None:
    """As ``match``, given the bigrams that the block shares with each template."""
    templates, best = template_index(threshold)[0], None
    for i, common in found.items():
        t = templates[i]
        if max(t.size, len(grams)) * threshold <= min(t.size, len(grams)) * (2 - threshold) + 1e-9:  # equality is within the bounds
            d = 2 * common / (len(grams) + t.size)
            if d >= threshold and (best is None or (-d, -t.size, t.name) < (-best[0], -best[2], best[1])) and agrees(t, words, grams):
                best = (d, t.name, t.size, not t.versions or bool(versions(words) & t.versions))
    return best


def match(words: list[str], threshold: float = THRESHOLD) -> tuple[float, str, int, bool] | None:
    """The best template at or above the threshold: (dice, name, bigrams of the template, does the block have its version?)."""
    _, index, least, most = template_index(threshold)
    if len(words) <= max(least, 1):
        return None
    grams = bigrams(words)
    if not least <= len(grams) <= most:
        return None
    return best_of(Counter(i for g in grams if g in index for i in index[g]), words, grams, threshold)


def possible(words: list[str], threshold: float) -> set[int]:
    """Templates that some part of the text can match: of their bigrams, t/(2-t) or more are there."""
    templates, index, _, _ = template_index(threshold)
    there = Counter(i for g in bigrams(words) if g in index for i in index[g])
    return {i for i, n in there.items() if n * (2 - threshold) >= templates[i].size * threshold - 1e-9}


def paragraph_runs(paragraphs: list[list[str]], candidates: set[int], threshold: float) -> Iterator[tuple[float, str, int, bool]]:
    """The best template of each run of two consecutive paragraphs or more that matches one of the candidates."""
    templates, index, _, _ = template_index(threshold)
    most = max(templates[i].size for i in candidates) * (2 - threshold) / threshold
    hits = {g: c for p in [[w for p in paragraphs for w in p]] for g in bigrams(p) if (c := candidates.intersection(index.get(g, ())))}
    for first, start in enumerate(paragraphs[:-1]):
        if not any(g in hits for g in zip(start, start[1:] + paragraphs[first + 1][:1])):
            continue  # the run without this paragraph is closer to any template
        words, grams, common = [], set(), Counter()
        for last in range(first, len(paragraphs)):
            at = max(len(words) - 1, 0)
            words += paragraphs[last]
            for g in zip(words[at:], words[at + 1:]):
                if g not in grams:
                    grams.add(g)
                    common.update(hits.get(g, ()))
            if len(grams) > most:
                break
            if last > first and (best := best_of(common, words, grams, threshold)):
                yield best


def scan(text: str | None, threshold: float = THRESHOLD) -> list[tuple[str, float, str]]:
    """(licence, best dice, where: line, paragraph, paragraphs or document) of each licence found, best first."""
    found: dict[str, tuple[float, str]] = {}
    if not text or not (candidates := possible(normalised_words(text), threshold)):
        return []
    sure = set()

    def note(best: tuple[float, str, int, bool], where: str) -> None:
        d, name, _, versioned = best
        if versioned:
            sure.add(name)
        if d > found.get(name, (0, ""))[0]:
            found[name] = (d, where)

    paragraphs = PARAGRAPHS.split(text)
    for where, blocks in (("line", text.split("\n")), ("paragraph", [p for p in paragraphs if "\n" in p]), ("document", [text] * (len(paragraphs) > 1))):
        for block in blocks:
            if len(block) > 2 and (best := match(normalised_words(block), threshold)):
                note(best, where)
    if len(paragraphs) > 2:
        for best in paragraph_runs([w for p in paragraphs if (w := normalised_words(p))], candidates, threshold):
            note(best, "paragraphs")
    # A block without a version is a part of the notice that has it, if there is one of the family.
    families = {n.rsplit("-", 1)[0] for n in sure}
    return sorted(((n, d, w) for n, (d, w) in found.items() if n in sure or n.rsplit("-", 1)[0] not in families), key=lambda f: (-f[1], f[0]))


def scan_licenses(docs: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, license, dice, found_in, licenses) for every row of ``docs``: the best licence and all that were found."""
    ship(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(t, threshold) for t in batch.column(1).to_pylist()]
            best = [f[0] if f else (None, None, None) for f in found]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "license": pa.array([b[0] for b in best], pa.string()),
                "dice": pa.array([b[1] for b in best], pa.float64()), "found_in": pa.array([b[2] for b in best], pa.string()),
                "licenses": pa.array([[n for n, _, _ in f] for f in found], pa.list_(pa.string()))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        of, "doc_id long, license string, dice double, found_in string, licenses array<string>")
