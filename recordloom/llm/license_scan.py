"""License scans (operator 2): the Dice coefficient of word bigrams with licence templates.

A text's words, lower-cased and without punctuation, are compared with each template
over every run of words whose size leaves the wanted coefficient possible: bigram
multisets of a and b members have a Dice coefficient of at least t only if the
smaller has t / (2 - t) of the larger. So a template is a candidate only if the text
holds that share of its bigrams close enough together, and a run begins and ends
with a bigram of the template, as one trimmed to these has no smaller coefficient.
"""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from recordloom.llm.common import map_arrow, table
from recordloom.llm.decontaminate import words_of

#: The least Dice coefficient of a finding.
LEAST = 0.8

_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_ENDORSE = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY "
    "AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
# The public texts of licences and of the notices that point to them.
TEMPLATES = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _WARRANTY),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", _BSD + _DISCLAIMER),
    ("BSD-2-Clause", _BSD),
    ("BSD-3-Clause", _BSD + "3. " + _ENDORSE + " " + _DISCLAIMER),
    ("BSD-3-Clause", _ENDORSE),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]


class Templates:
    """Templates as bigram multisets over numbered words."""

    def __init__(self, templates: list[tuple[str, str]], least: float = LEAST):
        self.least = least
        listed = [words_of(text) for _, text in templates]
        self.number = {w: i for i, w in enumerate(dict.fromkeys(w for words in listed for w in words))}
        self.own = []
        for (name, _), words in zip(templates, listed, strict=True):
            pairs = Counter(self.pairs(words).tolist())
            self.own.append((name, len(words), pairs, np.asarray(sorted(pairs)), sum(pairs.values())))

    def pairs(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the bigrams; -1 where a word is in no template."""
        at = np.fromiter((self.number.get(w, -1) for w in words), np.int64, len(words))
        return np.where((at[:-1] < 0) | (at[1:] < 0), -1, at[:-1] * len(self.number) + at[1:]) if len(at) > 1 else np.empty(0, np.int64)

    def found(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """Findings ``(licence, Dice, first word, end)``: each licence's best run, the earliest of equals."""
        words = words_of(text)
        pairs = self.pairs(words)
        known = np.flatnonzero(pairs >= 0)
        best: dict[str, tuple] = {}
        for name, _, wanted, members, n in self.own:
            need = math.ceil(self.least * n / (2 - self.least) - 1e-9)
            most = math.floor(n * (2 - self.least) / self.least + 1e-9)
            if not n or len(known) < need:
                continue
            at = known[np.isin(pairs[known], members)]
            if len(at) < need:
                continue
            close = np.flatnonzero(at[need - 1 :] - at[: len(at) - need + 1] < most)
            for first in close.tolist():
                dice, last = self.run(pairs[at[first : np.searchsorted(at, at[first] + most)]], at[first:], wanted, n)
                if dice >= self.least - 1e-12 and (name not in best or dice > best[name][1]):
                    best[name] = (name, dice, int(at[first]), int(last) + 2)
                    if dice == 1.0:
                        break
        return sorted(best.values(), key=lambda f: (-f[1], f[2], f[0]))

    @staticmethod
    def run(got: np.ndarray, at: np.ndarray, wanted: Counter, n: int) -> tuple[float, int]:
        """The best Dice of the runs that begin with the bigram at ``at[0]``, and the place of the last bigram of the shortest such run."""
        order = np.argsort(got, kind="stable")
        listed = got[order]
        starts = np.flatnonzero(np.append(True, listed[1:] != listed[:-1]))
        rank = np.empty(len(got), np.int64)
        rank[order] = np.arange(len(got)) - np.repeat(starts, np.diff(np.append(starts, len(got))))
        counts = np.fromiter((wanted[x] for x in got.tolist()), np.int64, len(got))
        dice = 2 * np.cumsum(rank < counts) / (n + at[: len(got)] - at[0] + 1)
        return float(dice.max()), int(at[int(dice.argmax())])


def templates_in(folder: str) -> list[tuple[str, str]]:
    """Templates from a folder of the driver that holds whole licence texts, named by the files: for the licences whose body is not among ``TEMPLATES``."""
    return [(p.name.removesuffix(".txt"), p.read_text(encoding="utf-8", errors="replace")) for p in sorted(Path(folder).iterdir()) if p.is_file() and not p.is_symlink()]


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, *, least: float = LEAST) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_licenses, license, dice, licenses``.

    ``license`` and ``dice`` are the best finding (null if there is none); ``licenses``
    joins all as ``licence:first_word:end`` by comma, best first. Words are counted
    over the whole text. Null and empty texts find nothing. Templates are a constant
    of the code. Repeated rows repeat; an empty table gives no rows.
    """
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n_licenses", LongType()), StructField("license", StringType()), StructField("dice", DoubleType()), StructField("licenses", StringType())])
    own = Templates(templates, least)

    def run(ids: list, texts: list) -> list:
        got = [own.found(t) for t in texts]
        return [ids, list(map(len, got)), [g[0][0] if g else None for g in got], [g[0][1] if g else None for g in got], [",".join(f"{n}:{s}:{e}" for n, _, s, e in g) for g in got]]

    return map_arrow(docs.select("doc_id", "text"), run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
