"""License notices by conditional compression.

A candidate block is a run of neighbouring lines that name a licence or a right (TRIGGER). The part of each line that a template
could take is compressed alone and with the template as a raw dictionary, for each template that the line has the words for;
templates are ranked by what they save and, in that order, held against the line word by word: one whose words the line holds in order, up to MAX_MISSING of them, without a
deciding word (a version, a condition, a name) missing or added, is confirmed, and its words are taken. So notices side
by side on a line are all found. A line longer than any wording is judged in stretches round the words that name a licence. The block
as a whole is judged if no line of it holds a notice. Besides, each such line is judged with the lines around it, as far as the
longest wording reaches, for wordings that run over lines of which some name nothing (whole licence texts among them);
these are rows with the lines that they take, and shorter wordings within them are no rows of their own.

Edge cases: null and empty texts have no blocks; a block that no template fits is not a row unless
`unconfirmed=True`, then with a null license_id; ties in saving go to the template that sorts first; repeated rows
give rows each; a null doc_id is kept; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import difflib
import functools
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytolake.llm.common import docs_of, lean, slices, table

#: A line with one of these stems belongs to a candidate block; the text search by Spark and the line search agree.
TRIGGER = r"(?i)licen[cs]|copyright|\(c\)|all rights reserved|public domain|spdx|permission is|redistribut|warrant|creative commons|\bcc[ -]by|\bcc0"
LEAST_SAVING, MAX_MISSING, MAX_EXTRA = 0.2, 0.15, 0.6

#: Whole texts and headers of common licences; fixed values.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
_BSD_TWO = """:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_GPL = "This program is free software{colon} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation{either} version {version} of the License, or (at your option) any later version."
_GPL_TAIL = " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details."
_EPL = "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"

#: Names that notices give a licence, and its SPDX identifiers; fixed values.
NAMES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "Apache-2.0": (("the Apache License, Version 2.0",), ("Apache-2.0",)),
    "MIT": (("the MIT License",), ("MIT",)),
    "GPL-2.0": (("the GNU General Public License, version 2", "the GNU GPL v2"), ("GPL-2.0-only", "GPL-2.0-or-later")),
    "GPL-3.0": (("the GNU General Public License, version 3", "the GNU GPL v3"), ("GPL-3.0-only", "GPL-3.0-or-later")),
    "LGPL-2.1": (("the GNU Lesser General Public License, version 2.1",), ("LGPL-2.1-only", "LGPL-2.1-or-later")),
    "LGPL-3.0": (("the GNU Lesser General Public License, version 3",), ("LGPL-3.0-only", "LGPL-3.0-or-later")),
    "AGPL-3.0": (("the GNU Affero General Public License, version 3",), ("AGPL-3.0-only", "AGPL-3.0-or-later")),
    "BSD-2-Clause": (("the BSD 2-Clause License",), ("BSD-2-Clause",)),
    "BSD-3-Clause": (("the BSD 3-Clause License",), ("BSD-3-Clause",)),
    "ISC": (("the ISC License",), ("ISC",)),
    "Unlicense": (("the Unlicense",), ("Unlicense",)),
    "Zlib": (("the zlib License",), ("Zlib",)),
    "MPL-2.0": (("the Mozilla Public License 2.0",), ("MPL-2.0",)),
    "EPL-2.0": (("the Eclipse Public License 2.0",), ("EPL-2.0",)),
    "CC-BY-4.0": (("CC BY 4.0", "a Creative Commons Attribution 4.0 International License"), ("CC-BY-4.0",)),
    "CC-BY-SA-4.0": (("CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License"), ("CC-BY-SA-4.0",)),
    "CC-BY-NC-4.0": (("CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License"), ("CC-BY-NC-4.0",)),
    "CC-BY-ND-4.0": (("CC BY-ND 4.0", "a Creative Commons Attribution-NoDerivatives 4.0 International License"), ("CC-BY-ND-4.0",)),
    "CC0-1.0": (("CC0 1.0",), ("CC0-1.0",)),
}
#: Sentences that a notice puts a name in.
SAYINGS = ("Licensed under {}.", "Released under {}.", "This work is licensed under {}.")
#: Longer wordings; a licence's sentences and identifiers follow from NAMES.
WORDINGS: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (_APACHE, 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    "MIT": (_MIT, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    "GPL-2.0": tuple(_GPL.format(colon=";", kind="", either="; either", version=2) + tail for tail in ("", _GPL_TAIL.format(kind=""))),
    "GPL-3.0": tuple(_GPL.format(colon=":", kind="", either=", either", version=3) + tail for tail in ("", _GPL_TAIL.format(kind=""))),
    "LGPL-2.1": (_GPL.format(colon=";", kind="Lesser ", either="; either", version=2.1),),
    "LGPL-3.0": (_GPL.format(colon=":", kind="Lesser ", either=", either", version=3),),
    "AGPL-3.0": (_GPL.format(colon=":", kind="Affero ", either=", either", version=3),),
    "BSD-2-Clause": (_BSD_HEAD + _BSD_TWO + _BSD_TAIL,),
    "BSD-3-Clause": (_BSD_HEAD + _BSD_TWO + _BSD_THIRD + _BSD_TAIL, _BSD_HEAD),
    "ISC": (_ISC, _ISC.split("\n")[0]),
    "Unlicense": (_UNLICENSE, _UNLICENSE.split("\n")[0]),
    "Zlib": (_ZLIB,),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "EPL-2.0": (_EPL,),
    "CC0-1.0": ("This work is dedicated to the public domain under CC0 1.0.",),
    "Proprietary": ("All rights reserved.",),
}
TEMPLATES: dict[str, tuple[str, ...]] = {
    k: tuple(dict.fromkeys([say.format(n) for n in NAMES.get(k, ((), ()))[0] for say in SAYINGS] + [f"SPDX-License-Identifier: {x}" for x in NAMES.get(k, ((), ()))[1]] + list(WORDINGS.get(k, ()))))
    for k in sorted({*NAMES, *WORDINGS})
}
#: Words whose presence on one side only makes another licence of it, besides numbers.
DECIDING = {"apache", "mit", "gnu", "lesser", "affero", "bsd", "mozilla", "cc", "by", "sa", "nc", "nd", "cc0", "sharealike", "noncommercial", "noderivatives", "attribution", "clause", "only", "not", "gpl", "lgpl", "agpl", "mpl", "eclipse", "epl", "isc", "zlib", "unlicense"}
WORD = re.compile(r"[a-z]+[0-9]*|[0-9]+(?:\.[0-9]+)*")


#: Numbers of a list, which wordings have or leave out: at the start of a line or behind a sentence.
LISTED = re.compile(r"(?m)(^[^\w\n]*|[.;:)\]]\s+)\(?[0-9]+[.)](?=\s)")


LOWER = {c: c + 32 for c in range(65, 91)}


def spots(text: str) -> list[re.Match]:
    """The words of a text, in lower case, with their places in it."""
    plain = LISTED.sub(lambda m: m[1] + " " * (len(m[0]) - len(m[1])), text.translate(LOWER))
    return list(WORD.finditer(plain))


def words_of(text: str) -> list[str]:
    return [w[:-2] if re.fullmatch(r"[0-9]+\.0", w) else w for w in (m[0] for m in spots(text))]


def blocks(text: str) -> Iterator[tuple[int, str]]:
    """First line and text of each run of lines with a trigger."""
    find, held, first = re.compile(TRIGGER).search, [], 0
    for i, line in enumerate(text.split("\n")):
        if find(line):
            if not held:
                first = i
            held.append(line)
        elif held:
            yield first, "\n".join(held)
            held = []
    if held:
        yield first, "\n".join(held)


def _press(raw: bytes) -> int:
    return len(zstandard.ZstdCompressor(level=19, write_checksum=False, write_content_size=False).compress(raw))


@functools.cache
def wordings() -> list[tuple[str, str, list[str], Counter, zstandard.ZstdCompressor, int]]:
    """licence, wording, its words and their counts, the compressor with it as dictionary, its own compressed bytes."""
    out = []
    for name in sorted(TEMPLATES):
        for wording in TEMPLATES[name]:
            d = zstandard.ZstdCompressionDict(wording.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            press = zstandard.ZstdCompressor(level=19, dict_data=d, write_checksum=False, write_content_size=False)
            t = words_of(wording)
            out.append((name, wording, t, Counter(t), press, _press(wording.encode())))
    return out


@functools.cache
def reach() -> int:
    """Words that a wording can take in a text, with those added."""
    return int(max(len(t) for _, _, t, *_ in wordings()) * (1 + MAX_EXTRA)) + 1


def around(template: list[str], block: list[str]) -> tuple[int, int]:
    """The range of words round the longest common run that a confirmed wording can take."""
    m = difflib.SequenceMatcher(None, template, block, autojunk=False).find_longest_match()
    slack = int(MAX_EXTRA * len(template)) + 1
    return (max(0, m.b - m.a - slack), min(len(block), m.b + len(template) - m.a + slack)) if m.size else (0, 0)


def difference(template: list[str], block: list[str]) -> tuple[list[str], list[str], int, int]:
    """Template words that the block lacks, words between matched ones that the template lacks, and the places of the first
    and the last matched word; sought around the longest common run."""
    low, high = around(template, block)
    part = block[low:high]
    match = [m for m in difflib.SequenceMatcher(None, template, part, autojunk=False).get_matching_blocks() if m.size]
    if not match:
        return template, [], 0, 0
    hit_t = {i for m in match for i in range(m.a, m.a + m.size)}
    hit_b = {i for m in match for i in range(m.b, m.b + m.size)}
    lo, hi = min(hit_b), max(hit_b)
    return [w for i, w in enumerate(template) if i not in hit_t], [part[i] for i in range(lo, hi + 1) if i not in hit_b], low + lo, low + hi


def confirmed(t: list[str], b: list[str]) -> tuple[bool, int, int, int, int]:
    """Does the block hold the wording; words missing and added, places of the first and the last word."""
    missing, extra, lo, hi = difference(t, b)
    decides = lambda w: w in DECIDING or w[0].isdigit()
    ok = len(missing) <= MAX_MISSING * len(t) and len(extra) <= MAX_EXTRA * len(t) and not any(map(decides, missing)) and not any(map(decides, extra))
    return ok, len(missing), len(extra), lo, hi


def wrapped(text: str, taken: list[tuple[int, int, str]]) -> Iterator[tuple[int, str, tuple]]:
    """First line, lines and judgement of each wording that runs over lines around one with a trigger. taken: first and
    last line and licence of what is found already, which is not given again; nor is what lies within a wording of more lines."""
    find, lines = re.compile(TRIGGER).search, text.split("\n")
    told = [i for i, x in enumerate(lines) if find(x)]
    words = functools.cache(lambda i: words_of(lines[i]))
    whole: list[tuple[int, int]] = []
    for i in told:
        if any(a <= i <= b for a, b in whole):
            continue
        lo, n = i, 0
        least = max((b + 1 for _, b in whole), default=0)
        while lo > least and n < reach():
            lo -= 1
            n += len(words(lo))
        hi, n = i, 0
        while hi + 1 < len(lines) and n < reach():
            hi += 1
            n += len(words(hi))
        if lo == hi:
            continue
        held = [w for j in range(lo, hi + 1) for w in words(j)]
        line = [j for j in range(lo, hi + 1) for _ in words(j)]
        have, got = Counter(held), []
        for name, wording, t, count, c, _ in wordings():
            if not can_hold(have, t, count):
                continue
            ok, missing, extra, first, last = confirmed(t, held)
            first, last = line[first], line[last]
            if ok and first < last:
                block = "\n".join(lines[first : last + 1])
                raw = block.encode()
                alone = _press(raw)
                saved = alone - len(c.compress(raw))
                got.append((-saved, name, wording, first, last, block, (name, alone, alone - saved, saved / alone, missing, extra)))
        for _, name, _, first, last, block, row in sorted(got):
            if not any(a <= last and first <= b and name == other for a, b, other in taken) and not any(a <= first and last <= b for a, b in whole):
                taken.append((first, last, name))
                whole.append((first, last))
                yield first, block, row


def can_hold(have: Counter, t: list[str], count: Counter) -> bool:
    """Has a text with these words enough of a wording's words to be confirmed?"""
    most = MAX_MISSING * len(t)
    return len(count.keys() - have.keys()) <= most and (count - have).total() <= most


@functools.lru_cache(4096)
def judge(block: str, every: bool = False) -> tuple[tuple, ...]:
    """Of each confirmed notice of a block: licence, bytes alone, bytes with the wording, saving, words missing and added. For
    each wording, the part of the block that it could take is compressed; wordings are tried by what they save, and words
    that one has taken are not another's. Those whose words the block lacks are left out at once, unless every: then a block
    without a notice gives its nearest wording, with a null licence."""
    place, held, ranked, out = spots(block), words_of(block), [], []
    have = Counter(held)
    for name, wording, t, count, c, own in wordings():
        if every or can_hold(have, t, count):
            low, high = around(t, held)
            raw = (block[place[low].start() : place[high - 1].end()] if high - low < len(held) and high else block).encode()
            alone = _press(raw)
            ranked.append((alone - len(c.compress(raw)), name, wording, t, alone, own))
    ranked.sort(key=lambda x: (-x[0], x[1], x[2]))
    for saved, name, _, t, alone, own in ranked:
        while saved >= LEAST_SAVING * min(alone, own):  # own words between and around a wording's count against alone
            ok, missing, extra, lo, hi = confirmed(t, held)
            if not ok:
                break
            out.append((name, alone, alone - saved, saved / alone, missing, extra))
            held[lo : hi + 1] = ["\0"] * (hi + 1 - lo)
    if every and not out:
        saved, *_, alone, _ = ranked[0]
        out.append((None, alone, alone - saved, saved / alone, 0, 0))
    return tuple(out)


def parts(line: str) -> Iterator[str]:
    """A line as it is or, if it is longer than any wording can be, stretches of it round the places that name a licence or a
    right: a wording round such a place lies whole in one of them, and stretches do not overlap in what they settle."""
    place = [m.span() for m in re.finditer(r"\w+", line)] if len(line) > 4 * reach() else []
    if len(place) <= 4 * reach():
        yield line
        return
    start, done = [a for a, _ in place], 0
    for m in re.finditer(TRIGGER, line):
        i = max(bisect.bisect_right(start, m.start()) - 1, 0)
        if i >= done:
            a, b = max(done, i - reach()), min(len(place), i + 3 * reach())
            if b < len(place):  # what begins in the last stretch of a wording's length is left to the next part
                b = max(i + 1, b)
            yield line[place[a][0] : place[b - 1][1]]
            done = i + 2 * reach()


_OUT = pa.schema([("doc_id", pa.int64()), ("first_line", pa.int64()), ("license_id", pa.string()), ("bytes_alone", pa.int64()), ("bytes_with_template", pa.int64()), ("saving", pa.float64()), ("missing_words", pa.int64()), ("extra_words", pa.int64()), ("block", pa.string())])


def _scan(unconfirmed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = []
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                taken = []
                for first, block in blocks(text):
                    lines = [(first + i, part, judge(part)) for i, x in enumerate(block.split("\n")) for part in parts(x)]
                    if not any(got for _, _, got in lines):  # a wording that runs over lines
                        lines = [(first, block, judge(block, unconfirmed))]
                    out += [(doc, line, *row, x) for line, x, got in lines for row in got]
                    taken += [(line, line + x.count("\n"), row[0]) for line, x, got in lines for row in got if row[0]]
                out += [(doc, line, *got, x) for line, x, got in wrapped(text, taken)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _OUT, strict=True)], schema=_OUT)

    return run


def scan(docs: DataFrame, unconfirmed: bool = False) -> DataFrame:
    """A row for each confirmed block of each text."""
    some = docs_of(docs).where(F.col("text").rlike(TRIGGER))
    return some.mapInArrow(lean(_scan(unconfirmed)), "doc_id long, first_line long, license_id string, bytes_alone long, bytes_with_template long, saving double, missing_words long, extra_words long, block string")


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
