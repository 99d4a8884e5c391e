"""License scans by conditional compression.

Candidate blocks are the words around a cue such as "license"; overlapping blocks are one. A
block is compressed alone and with each template as a zstandard raw-content dictionary; the
template that saves most is the winner, ranked by the bytes saved; what is left of the block before and
after a winner's words is scanned again until nothing is found. A winner counts only if its
exact wording differs from the block in few words, none of them the name, a clause or the version of
another license: the template is aligned word by word, and the words missing and added are reported; a
word in place of another is one difference.

Work is per document; no shuffle. Only documents with a cue leave the JVM.

Cases: null and empty texts have no block; of templates that save equally the first by name wins;
repeated rows and several blocks of a document each give a row; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Whole short license texts and the usual notices of licenses.
_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT '
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution. "
)
_ADVERTISING = (
    "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product "
    "includes software developed by the copyright holder. "
)
_ENDORSE = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission. "
)
_GNU = (
    "This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free "
    "Software Foundation, either version {version} of the License, or (at your option) any later version. This {thing} is distributed in "
    "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
    "PARTICULAR PURPOSE. See the GNU {name} for more details."
)
TEMPLATES = {
    "Apache-1.1": "Licensed under the Apache License, Version 1.1.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific '
        "language governing permissions and limitations under the License."
    ),
    "BSD": "Released under the BSD License.",
    "BSD-2-Clause": _BSD + _AS_IS,
    "BSD-3-Clause": _BSD + "3. " + _ENDORSE + _AS_IS,
    "BSD-4-Clause": _BSD + _ADVERTISING + "4. " + _ENDORSE + _AS_IS,
    "CC0-1.0": "This work is dedicated to the public domain under the Creative Commons CC0 1.0 Universal License.",
    "ISC": "Released under the ISC License.",
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
        "THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "MIT": "Released under the MIT License.",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
        "whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        'shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
        "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
        "THE SOFTWARE."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, "
        "or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and "
        "by any means."
    ),
}
for _version in ("1.1", "2.0"):
    TEMPLATES[f"MPL-{_version}"] = f"Licensed under the Mozilla Public License, Version {_version}."
TEMPLATES["MPL-2.0 header"] = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
    "file, You can obtain one at http://mozilla.org/MPL/2.0/."
)
for _family, _name, _versions in (
    ("GPL", "General Public License", ("1", "2", "3")),
    ("LGPL", "Library General Public License", ("2",)),
    ("LGPL", "Lesser General Public License", ("2.1", "3")),
    ("AGPL", "Affero General Public License", ("3",)),
):
    for _version in _versions:
        _full = f"{_family}-{_version}" if "." in _version else f"{_family}-{_version}.0"
        TEMPLATES[_full] = f"This work is licensed under the GNU {_name}, version {_version}."
        for _thing in ("program", "library"):
            TEMPLATES[f"{_full} notice, {_thing}"] = _GNU.format(thing=_thing, name=_name, version=_version)
for _version, _port in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic"), ("1.0", "Generic")):
    for _form, _name in (
        ("BY", "Attribution"),
        ("BY-SA", "Attribution-ShareAlike"),
        ("BY-ND", "Attribution-NoDerivatives"),
        ("BY-NC", "Attribution-NonCommercial"),
        ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    ):
        TEMPLATES[f"CC-{_form}-{_version}"] = f"This work is licensed under a Creative Commons {_name} {_version} {_port} License."
        TEMPLATES[f"CC-{_form}-{_version} short"] = f"Licensed under CC {_form} {_version}."
CUES = (
    r"(?i)licen[cs]e|permission\s+is\s+hereby\s+granted|permission\s+to\s+use|redistribution\s+and\s+use|"
    r"unencumbered\s+software"
)

# Words that tell licenses apart, and published versions: a text that differs in them is under another license.
_TELLING = re.compile(
    r"mit|bsd|isc|apache|gnu|mozilla|mpl|[al]?gpl|lesser|affero|general|public|documentation|creative|commons|cc0?|by(nc|nd|sa)*|attribution\w*|"
    r"noncommercial\w*|sharealike|noderiv\w*|advertising|acknowledge?ment|endorse|promote|eclipse|boost|artistic|zlib|proprietary"
)
_VERSIONS = {
    "Apache": {"1.0", "1.1", "2", "2.0"},
    "GPL": {"1", "1.0", "2", "2.0", "3", "3.0"},
    "LGPL": {"2", "2.0", "2.1", "3", "3.0"},
    "AGPL": {"1", "1.0", "3", "3.0"},
    "MPL": {"1.0", "1.1", "2", "2.0"},
    "CC": {"1.0", "2.0", "2.1", "2.5", "3.0", "4.0"},
}
MAX_DIFFERENCES = 0.2
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BARE = re.compile(r"[^\w.]+")


def _bare(word: str) -> str:
    return _BARE.sub("", word).strip(".").lower()


def _bare_words(words: list[str]) -> list[str]:
    """Words to compare; a Library General Public License is a Lesser one by its first name."""
    bare = [_bare(w) for w in words]
    return ["lesser" if pair == ("library", "general") else pair[0] for pair in zip(bare, [*bare[1:], ""], strict=False)]


def _is_other_license(name: str, missing: list[str], added: list[str]) -> bool:
    """Whether words in place of others stand for another license than ``name``. A version that was never
    published does not: it is reported as a difference."""
    if any(_TELLING.fullmatch(w) for w in {*missing} ^ {*added}):
        return True
    found = re.match(r"(\w+).*?-(\d[\d.]*)( |$)", name)
    if found is None:
        return False
    family, version = found[1], found[2]
    own = {version, version.removesuffix(".0")}
    if not own.intersection(missing):
        return False
    numbers = {w for w in added if w[:1].isdigit()}
    return not numbers or bool(numbers & _VERSIONS.get(re.match("[A-Z]*[a-z]*", family)[0], set()) - own)


class LicenseScanner:
    def __init__(self, templates: dict[str, str], level: int = 9):
        self.names = sorted(templates)
        self.words = {n: _bare_words(_WORD.findall(templates[n])) for n in self.names}
        self.alone = zstandard.ZstdCompressor(level=level)
        self.given = {
            n: zstandard.ZstdCompressor(
                level=level,
                dict_data=zstandard.ZstdCompressionDict(templates[n].encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for n in self.names
        }
        self.reach = max(map(len, self.words.values()), default=0)

    def blocks(self, text: str) -> Iterator[tuple[int, int]]:
        """Spans of characters: ``reach`` words to either side of each cue, overlapping ones joined."""
        start = end = None
        for cue in re.finditer(CUES, text):
            at, width = cue.start(), 40 * self.reach
            left = [m.start() + max(0, at - width) for m in _WORD.finditer(text, max(0, at - width), at)][-self.reach :]
            right = [m.end() for m in _WORD.finditer(text, at, min(len(text), cue.end() + width))][: self.reach + 3]
            a = left[0] - max(0, at - width) if left else at
            b = right[-1] if right else cue.end()
            if end is not None and a < end:
                end = max(end, b)
                continue
            if start is not None:
                yield start, end
            start, end = a, b
        if start is not None:
            yield start, end

    def alignments(self, name: str, words: list[str]) -> Iterator[tuple[int, int, int, str]]:
        """First and last word that the template can stand for, number and list of differences, for each place
        that holds a run of words as long as any place within the limit must have; longest runs first."""
        template = self.words[name]
        allowed = int(MAX_DIFFERENCES * len(template))
        least = max(1, -(-(len(template) - allowed) // (allowed + 1)))
        todo = [(0, len(words))]
        while todo:
            lo, hi = todo.pop()
            core = difflib.SequenceMatcher(None, template, words[lo:hi], autojunk=False).find_longest_match()
            if core.size >= least:
                at = lo + core.b
                yield self.differences(name, words, core.a, at, core.size)
                todo += [(at + core.size, hi), (lo, at)]

    def differences(self, name: str, words: list[str], core_a: int, core_b: int, size: int) -> tuple[int, int, int, str]:
        """First and last word that the template aligns with around equal words, number and list of differences."""
        template = self.words[name]
        lo, hi = max(0, core_b - 2 * core_a - 2), core_b + size + 2 * (len(template) - core_a - size) + 2
        near = difflib.SequenceMatcher(None, template, words[lo:hi], autojunk=False)
        same = [m for m in near.get_matching_blocks() if m.size]
        if not same:
            return 0, 0, len(template), ""
        # Words before the first and after the last match stand for the template's words there.
        first = max(0, lo + same[0].b - same[0].a)
        last = min(len(words), lo + same[-1].b + len(template) - same[-1].a)
        inside = difflib.SequenceMatcher(None, template, words[first:last], autojunk=False)
        changes, count = [], 0
        for op, a, b, c, d in inside.get_opcodes():
            if op != "equal":
                if _is_other_license(name, template[a:b], words[first:last][c:d]):
                    return 0, 0, len(template), ""
                count += max(b - a, d - c)
                changes += [f"-{w}" for w in template[a:b]] + [f"+{w}" for w in words[first:last][c:d]]
        return first, last, count, " ".join(changes)

    def best(self, part: str, words: list[str]) -> tuple[int, int, int, str, str, int] | None:
        """The first template, by the bytes saved, that aligns within the limit: as ``differences``, name and bytes."""
        data = part.encode()
        size = len(self.alone.compress(data))
        for less, name in sorted((len(self.given[n].compress(data)) - size, n) for n in self.names):
            if less >= 0:
                return None
            for first, last, n_changes, changes in self.alignments(name, words):
                if last and n_changes <= MAX_DIFFERENCES * len(self.words[name]):
                    return first, last, n_changes, changes, name, -less
        return None

    def scan(self, text: str) -> Iterator[dict]:
        for start, end in self.blocks(text):
            spans = [(start + m.start(), start + m.end()) for m in _WORD.finditer(text[start:end])]
            words = _bare_words([text[a:b] for a, b in spans])
            # What is left before and after a notice is scanned again.
            parts = [(0, len(spans))]
            while parts:
                lo, hi = parts.pop()
                if lo == hi or not re.search(CUES, part := text[spans[lo][0] : spans[hi - 1][1]]):
                    continue
                found = self.best(part, words[lo:hi])
                if found is None:
                    continue
                first, last, n_changes, changes, name, saved = found
                yield {
                    "license": name,
                    "start": spans[lo + first][0],
                    "end": spans[lo + last - 1][1],
                    "saved_bytes": saved,
                    "n_differences": n_changes,
                    "differences": changes,
                }
                parts += [(lo + last, hi), (lo, lo + first)]


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, license, start, end, saved_bytes, n_differences, differences``: one row per notice found;
    ``start`` and ``end`` are character offsets in the text."""
    templates = TEMPLATES if templates is None else templates
    schema = "doc_id long, license string, start long, end long, saved_bytes long, n_differences long, differences string"
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).filter(F.col("text").rlike(CUES))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = LicenseScanner(templates)
        for batch in batches:
            found = [
                {"doc_id": doc_id} | hit
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for hit in scanner.scan(text)
            ]
            yield pa.RecordBatch.from_pylist(found, _ARROW)

    return rows.mapInArrow(scan, schema)


_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("license", pa.string()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("saved_bytes", pa.int64()),
        ("n_differences", pa.int64()),
        ("differences", pa.string()),
    ]
)
