"""License scans by conditional compression.

Lines with a licensing word, and short gaps between such lines, form candidate blocks. A block and the
text that follows it are compressed by zstandard alone and with each template as raw dictionary. In the
order of the bytes saved, a template is confirmed by its exact wording: aligned word by word where the
words that name its license occur, enough of its words must stand in a span that holds little else and
isn't denied. The first that is confirmed is taken out, and what stands before and after it is compressed
and ranked again until no template is confirmed, so a block gives as many rows as it has notices. SPDX
expressions are read by their grammar, known identifiers only. A block without any notice is given the
template that saves most, unconfirmed. Rows are scanned where they lie; nothing is shuffled or broadcast
but the few templates.
"""

from __future__ import annotations

import difflib
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from .common import Batches, slices, table

LEVEL = 9
COVERAGE = 0.75  #: share of the template's words that a span must hold in order, and of the span's that are the template's
GAP_LINES = 2  #: so many lines without a licensing word may stand inside a block

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_THIRD = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission."
)
_BSD_DISCLAIMER = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT '
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _gnu(name: str, version: str) -> tuple[str, ...]:
    return (
        f"This work is licensed under the GNU {name} Public License, version {version}.",
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} Public License "
        f"as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.",
    )


#: name -> (words that must occur, notices); fixed values: the licenses' customary wording.
TEMPLATES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "Apache-2.0": (
        ("apache", "2.0"),
        (
            "Licensed under the Apache License, Version 2.0.",
            'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
            "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
            'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES '
            "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
            "limitations under the License.",
        ),
    ),
    "MIT": (
        ("mit",),
        ("Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the terms of the MIT license."),
    ),
    "MIT-text": (
        ("permission", "software"),
        (
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
            "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
            "shall be included in all copies or substantial portions of the Software.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
            "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
            'shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY '
            "OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
            "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
            "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
            "THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        ),
    ),
    "GPL-3.0": (
        ("gnu", "general", "public", "3"),
        (
            "This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
            "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        ),
    ),
    "GPL-2.0": (
        ("gnu", "general", "public", "2"),
        (
            "This work is licensed under the GNU General Public License, version 2.",
            "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
            "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        ),
    ),
    "LGPL-3.0": (("gnu", "lesser", "general", "public", "3"), _gnu("Lesser General", "3")),
    "LGPL-2.1": (("gnu", "lesser", "general", "public", "2.1"), _gnu("Lesser General", "2.1")),
    "AGPL-3.0": (("gnu", "affero", "general", "public", "3"), _gnu("Affero General", "3")),
    "BSD-3-Clause": (
        ("redistribution", "source", "binary", "neither", "endorse"),
        (_BSD + _BSD_THIRD, _BSD + _BSD_THIRD + _BSD_DISCLAIMER),
    ),
    "BSD-2-Clause": (("redistribution", "source", "binary"), (_BSD, _BSD + _BSD_DISCLAIMER)),
    "CC-BY-4.0": (
        ("cc", "by", "4.0"),
        ("CC BY 4.0", "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License (CC BY 4.0)."),
    ),
    "CC-BY-SA-4.0": (
        ("cc", "by-sa", "4.0"),
        ("CC BY-SA 4.0", "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License (CC BY-SA 4.0)."),
    ),
    "CC-BY-NC-4.0": (
        ("cc", "by-nc", "4.0"),
        ("CC BY-NC 4.0", "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License (CC BY-NC 4.0)."),
    ),
    "MPL-2.0": (
        ("mozilla", "public", "2.0"),
        (
            "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
            "with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
            "Licensed under the Mozilla Public License, version 2.0.",
        ),
    ),
    "ISC": (
        ("permission", "fee", "granted"),
        (
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
            '"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
            "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
            "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
            "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        ),
    ),
    "Unlicense": (
        ("unencumbered", "public", "domain"),
        (
            "This is free and unencumbered software released into the public domain.",
            "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
            "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
            "non-commercial, and by any means.",
        ),
    ),
    "EPL-2.0": (
        ("eclipse", "public", "2.0"),
        (
            "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
            "available at https://www.eclipse.org/legal/epl-2.0/",
            "Licensed under the Eclipse Public License, version 2.0.",
        ),
    ),
    "all-rights-reserved": (("rights", "reserved"), ("All rights reserved.", "Copyright (c) 2020 The Authors. All rights reserved.")),
}

#: name -> other words that name the license as well
ALSO_NAMED = {
    "CC-BY-4.0": ("creative", "commons", "attribution", "4.0"),
    "CC-BY-SA-4.0": ("creative", "commons", "attribution-sharealike", "4.0"),
    "CC-BY-NC-4.0": ("creative", "commons", "attribution-noncommercial", "4.0"),
}
#: name -> words that name a relative; a span with one is not this license
NOT_NAMED = {
    "GPL-3.0": {"lesser", "library", "affero"},
    "GPL-2.0": {"lesser", "library", "affero"},
    "BSD-2-Clause": {"endorse"},
}
#: words that, shortly before a span or inside it, deny the license
DENIALS = {"not", "never", "neither", "nor", "isn", "aren", "wasn", "no"}

#: SPDX identifiers that are read; fixed values.
SPDX_IDS = """
0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent
BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0
CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 GFDL-1.3 GPL-1.0
GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later HPND ISC LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1
LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later LPPL-1.3c MIT MIT-0 MPL-1.1 MPL-2.0 MPL-2.0-no-copyleft-exception
MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.1 OSL-3.0 PostgreSQL PSF-2.0 Python-2.0 Ruby SSPL-1.0 UPL-1.0 Unicode-3.0 Unlicense
Vim W3C WTFPL X11 Zlib ZPL-2.1
""".split()
_SPDX_NAMES = {name.lower(): name for name in SPDX_IDS}
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*", re.IGNORECASE)
_SPDX_PART = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.\-]*\+?)")
_SPDX_EXCEPTION = re.compile(r"[a-z0-9.\-]*exception[a-z0-9.\-]*", re.IGNORECASE)


def spdx_licenses(text: str, at: int) -> list[tuple[int, int, str]]:
    """(start, end, identifier) of the licenses of the SPDX expression at ``at``, as far as it follows the grammar."""
    found, open_, wants_license = [], 0, True
    while part := _SPDX_PART.match(text, at):
        word = part.group(1)
        name = _SPDX_NAMES.get(word.removesuffix("+").lower()) or (word.removesuffix("+") if word.startswith("LicenseRef-") else None)
        if wants_license and word == "(":
            open_ += 1
        elif wants_license and name:
            found.append((part.start(1), part.end(1), name + "+" * word.endswith("+")))
            wants_license = False
        elif not wants_license and word == ")" and open_:
            open_ -= 1
        elif not wants_license and word.upper() in ("AND", "OR"):
            wants_license = True
        elif not wants_license and word.upper() == "WITH" and (exception := _SPDX_PART.match(text, part.end())) and _SPDX_EXCEPTION.fullmatch(exception.group(1)):
            part = exception
        else:
            break
        at = part.end()
    return found


_CUE = re.compile(r"licen[sc]|copyright|redistribut|permission is|rights reserved|spdx|creative commons|permission to use|mozilla public|eclipse public|public domain|\bcc by\b|©", re.IGNORECASE)
_WORD = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")


def wording(text: str) -> list[str]:
    """Lower-cased words; version numbers and hyphenated names stay whole."""
    return _WORD.findall(text.lower())


def candidate_blocks(text: str) -> list[tuple[int, str]]:
    """(character offset, block) of every run of lines with licensing words."""
    if not _CUE.search(text):
        return []
    blocks: list[list[int]] = []  # first and last line, by offsets
    at, plain = 0, GAP_LINES + 1
    for line in text.splitlines(keepends=True):
        end = at + len(line.rstrip("\r\n"))
        if _CUE.search(line):
            if plain <= GAP_LINES:
                blocks[-1][1] = end
            else:
                blocks.append([at, end])
            plain = 0
        else:
            plain = GAP_LINES + 1 if not line.strip() else plain + 1
        at += len(line)
    return [(a, text[a:b]) for a, b in blocks]


class Scanner:
    """Compressors of all templates; one per worker."""

    def __init__(self, templates: dict[str, tuple[tuple[str, ...], tuple[str, ...]]]):
        plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.alone = zstandard.ZstdCompressor(**plain)
        self.templates = []
        for name, (needed, notices) in templates.items():
            raw = zstandard.ZstdCompressionDict("\n".join(notices).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.templates.append((name, needed, [wording(n) for n in notices], zstandard.ZstdCompressor(dict_data=raw, **plain)))
        self.named = [
            ([set(needed), *([set(ALSO_NAMED[name])] if name in ALSO_NAMED else [])], NOT_NAMED.get(name, set()), [(n, Counter(n)) for n in notices])
            for name, needed, notices, _ in self.templates
        ]
        self.reach = 2 * max(len(n) for _, notices in templates.values() for n in notices)  # characters

    def ranked(self, block: str) -> list[tuple[float, int]]:
        """(share of the compressed size saved, template number), best first; ties by number."""
        data = block.encode()
        size = len(self.alone.compress(data))
        return sorted((((size - len(t[3].compress(data))) / size, i) for i, t in enumerate(self.templates)), key=lambda x: (-x[0], x[1]))

    def nearest(self, block: str) -> tuple[str, float, int, str, str]:
        """The template that saves most: name, saving, words in common, words only of the block, only of the notice."""
        saved, i = self.ranked(block)[0]
        words = wording(block)
        found = [_compared(notice, words, whole=True) for notice in self.templates[i][2]]
        same, extra, missing, _, _ = max(found, key=lambda f: (f[0], -len(f[2])))
        return self.templates[i][0], saved, same, " ".join(extra), " ".join(missing)

    def fits(self, template: int, words: list[str], have: Counter) -> list[tuple]:
        """Where in ``words`` the template is confirmed, best first: (rank, same, extra, missing, first, end).

        A notice is skipped only if the words lack its name or too many of its words, whatever their order.
        """
        names, others, notices = self.named[template]
        found = []
        naming = next((n for n in names if all(have[w] for w in n)), None)
        for notice, parts in notices if naming else []:
            if sum(min(n, have[w]) for w, n in parts.items()) < COVERAGE * len(notice):
                continue
            anchor = min(sorted(naming & set(notice)) or sorted(naming), key=have.__getitem__)
            slack = len(notice) // 4 + 2
            starts = {j - i for j, w in enumerate(words) if w == anchor for i, v in enumerate(notice) if v == anchor}
            for start in sorted(starts):
                first = max(0, start - slack)
                window = words[first : start + len(notice) + slack]
                same, extra, missing, a, b = _compared(notice, window)
                inside = set(window[a:b])
                if same < COVERAGE * max(len(notice), b - a) or not any(n <= inside for n in names) or inside & others:
                    continue
                if DENIALS & {*words[max(0, first + a - 3) : first + a], *extra}:
                    continue
                found.append((same - len(extra) - len(missing), same, extra, missing, first + a, first + b))
        return sorted(found, key=lambda f: -f[0])

    def spans(self, text: str, marks: list[tuple[int, int, str]]) -> list[tuple]:
        """Every notice among the words of ``text`` at ``marks``: (name, same, extra, missing, first mark, end).

        The template that saves most of those confirmed is taken out; the words between are ranked again.
        """
        todo, found = [(0, len(marks))], []
        while todo:
            at, end = todo.pop()
            words = [m[2] for m in marks[at:end]]
            have = Counter(words)
            ranked = self.ranked(text[marks[at][0] : marks[end - 1][1]]) if at < end else []
            confirmed = ((i, fits) for _, i in ranked if (fits := self.fits(i, words, have)))
            template, fits = next(confirmed, (None, []))
            free, taken = np.ones(len(words), bool), []
            for _, *what, a, b in fits:
                if free[a:b].all():
                    free[a:b] = False
                    taken.append((a, b))
                    found.append((self.templates[template][0], *what, at + a, at + b))
            ends = [0, *(x for span in sorted(taken) for x in span), len(words)]
            todo += [(at + a, at + b) for a, b in zip(ends[::2], ends[1::2], strict=True) if taken and b > a]
        return sorted(found, key=lambda f: f[4])

    def scan(self, text: str | None) -> list[tuple]:
        blocks = candidate_blocks(text) if text else []
        regions: list[list[int]] = []  # blocks with the text that follows them, joined where they meet
        for offset, block in blocks:
            if regions and offset <= regions[-1][1]:
                regions[-1][1] = offset + len(block) + self.reach
            else:
                regions.append([offset, offset + len(block) + self.reach])
        spans = []  # (first character, end, license, saving, same, extra, missing)
        for begin, end in regions:
            marks = [(m.start() + begin, m.end() + begin, m.group()) for m in _WORD.finditer(text[begin:end].lower())]
            for name, same, extra, missing, a, b in self.spans(text, marks):
                piece = text[marks[a][0] : marks[b - 1][1]]
                saved = next(saved for saved, i in self.ranked(piece) if self.templates[i][0] == name)
                spans.append((marks[a][0], marks[b - 1][1], name, saved, same, " ".join(extra), " ".join(missing)))
        for offset, block in blocks:
            for m in _SPDX.finditer(block):
                spans += [(offset + a, offset + b, name, 0.0, 1, "", "") for a, b, name in spdx_licenses(block, m.end())]
        found = []
        for k, (offset, block) in enumerate(blocks):
            until = blocks[k + 1][0] if k + 1 < len(blocks) else len(text) + 1
            own = [s for s in sorted(spans) if offset <= s[0] < until]
            for a, b, name, saved, same, extra, missing in own:
                found.append((offset, len(block), name, saved, True, same, extra, missing, a, b - a))
            if not own and not any(s[0] < offset + len(block) and s[1] > offset for s in spans):
                name, saved, same, extra, missing = self.nearest(block)
                found.append((offset, len(block), name, saved, False, same, extra, missing, offset, len(block)))
        return found


def _compared(notice: list[str], words: list[str], whole: bool = False) -> tuple[int, list[str], list[str], int, int]:
    """Words in common in order, other words of the span, words missing from it, and the span's ends.

    The span is all words if ``whole``; else it ends with the matches, and a match at either end that is
    shorter than the gap to the next one is chance and left out.
    """
    matches = [m for m in difflib.SequenceMatcher(None, notice, words, autojunk=False).get_matching_blocks() if m.size]
    while not whole and len(matches) > 1 and matches[0].size < matches[1].b - matches[0].b - matches[0].size:
        matches.pop(0)
    while not whole and len(matches) > 1 and matches[-1].size < matches[-1].b - matches[-2].b - matches[-2].size:
        matches.pop()
    if not matches:
        return 0, words, notice, 0, len(words)
    a, b = (0, len(words)) if whole else (matches[0].b, matches[-1].b + matches[-1].size)
    theirs = {i for m in matches for i in range(m.b, m.b + m.size)}
    ours = {i for m in matches for i in range(m.a, m.a + m.size)}
    extra = [words[i] for i in range(a, b) if i not in theirs]
    return sum(m.size for m in matches), extra, [w for i, w in enumerate(notice) if i not in ours], a, b


@lru_cache(maxsize=1)
def _scanner() -> Scanner:
    return Scanner(TEMPLATES)


def scan_licenses(documents: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per notice: key, start and length of its candidate block in characters, license, saving,
    confirmed, n_same words, the wording differences ``extra`` and ``missing``, and the notice's own
    ``span_start`` and ``span_length``, which may pass the block's end. A block without a notice has one row.

    Whole texts are read. Null and empty texts have no blocks; repeated rows and null keys are scanned
    like any other; other columns are left out. ``confirmed`` false means: the nearest template only.
    """

    def run(batches: Batches):
        scanner = _scanner()
        for batch in slices(batches):
            rows = [(i, *hit) for i, t in enumerate(batch.column(1).to_pylist()) for hit in scanner.scan(t)]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 11
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns[1:], kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(columns[0], pa.int64())), *arrays], names=[key, *_COLUMNS])

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, start bigint, length bigint, license string, saving double, confirmed boolean, n_same bigint, extra string, missing string, span_start bigint, span_length bigint"
    )


_COLUMNS = ("start", "length", "license", "saving", "confirmed", "n_same", "extra", "missing", "span_start", "span_length")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
