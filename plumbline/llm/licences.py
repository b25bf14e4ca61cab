"""Licence scans by conditional compression: a block that a licence wrote costs few bytes given that licence's wording.

Words are runs of letters and digits without regard to case, so line ends, comment marks and punctuation do not matter. For each
template, blocks of words around its rarer words are compressed with and without the template as a raw dictionary; templates
are ranked by the share of bytes they save, and those that save enough are confirmed by their exact differences in wording.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_right
from collections import Counter
from difflib import SequenceMatcher
from math import ceil

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import once_per_worker, table, text_of

#: Notices and licence texts; several wordings may stand for one licence. The wordings are fixed by the licences.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a
        copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is
        distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("mit", "Released under the MIT License."),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in
        the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
        and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"""),
    ("mit", """The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("mit-warranty", """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
        FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""),
    ("mit-warranty", "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY"),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice
        and this permission notice appear in all copies."""),
    ("bsd-3-clause", "Released under the BSD 3-Clause License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd", """Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
        other materials provided with the distribution."""),
    ("bsd-3-clause", """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without
        specific prior written permission."""),
    ("bsd-3-clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0-or-later", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free
        Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("gpl-2.0-or-later", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free
        Software Foundation; either version 2 of the License, or (at your option) any later version."""),
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain
        one at http://mozilla.org/MPL/2.0/."""),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-nd-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("cc-by-4.0", "Creative Commons Attribution 4.0 International"),
    ("cc-by-sa-4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("cc-by-nc-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("cc0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]
WORD = re.compile(r"[^\W_]+")
#: Share of a template's words that must occur in order, and how many words, as a share of the template's, may stand between them.
#: Of templates with fewer than SHORT words, whose single words name the licence, all must occur.
MIN_WORDING, MAX_EXTRA, SHORT = 0.8, 0.25, 15
#: Share of a block's compressed bytes that a template must save to be confirmed.
MIN_REDUCTION = 0.1


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Template:
    """A wording with its gate: rare words of which every match holds at least `need`.

    A match holds at least `least` of the n words, so it lacks at most n - least of them. The gate takes longer words first until it covers
    that many places and a fifth of the words more: at least that fifth is left in any match.
    """

    def __init__(self, licence: str, text: str):
        self.licence, self.words = licence, words_of(text)
        n = len(self.words)
        self.least = n if n < SHORT else ceil(MIN_WORDING * n - 1e-9)
        self.reach = n + int(MAX_EXTRA * n)  # words of the widest match
        self.need = max(1, n // 5)
        count, self.gate, covered = Counter(self.words), set(), 0
        for w in sorted(count, key=lambda w: (-len(w), w)):
            if covered >= n - self.least + self.need:
                break
            self.gate.add(w)
            covered += count[w]
        raw = " ".join(self.words).encode()
        given = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        given.precompute_compress(level=3)
        self.given = zstandard.ZstdCompressor(dict_data=given, level=3)

    def regions(self, at: list[int], n: int) -> list[tuple[int, int]]:
        """Word ranges in which a match can lie, `at` being the places of gate words in a text of n words."""
        out: list[list[int]] = []
        for i in range(len(at) - self.need + 1):
            first, last = at[i], at[i + self.need - 1]
            if last - first < self.reach:
                lo, hi = max(0, last - self.reach + 1), min(n, first + self.reach)
                if out and lo <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], hi)
                else:
                    out.append([lo, hi])
        return [(lo, hi) for lo, hi in out]

    def blocks(self, at: list[int], n: int):
        """Overlapping blocks of the regions: every range of `reach` words in a region lies whole in one of them."""
        step = max(1, self.reach // 2)
        for lo, hi in self.regions(at, n):
            for start in range(lo, max(lo + 1, hi - self.reach + step), step):
                yield start, min(start + self.reach + step, hi)

    def wording(self, words: list[str]) -> tuple[int, list[str], int, int]:
        """(words found in order, differences, first and end word of the match in `words`)."""
        ops = SequenceMatcher(None, self.words, words, autojunk=False).get_opcodes()
        same = [o for o in ops if o[0] == "equal"]
        if not same:
            return 0, [], 0, 0
        lo, hi = same[0][3], same[-1][4]
        diff = []
        for op, a, b, c, d in ops:
            if op != "equal":
                diff += [f"-{w}" for w in self.words[a:b]] + [f"+{w}" for w in words[max(c, lo) : min(d, hi)]]
        return sum(o[2] - o[1] for o in same), diff, lo, hi

    def matches(self, words: list[str], lo: int, hi: int):
        """(start, stop, differences) of the confirmed wordings in words[lo:hi]."""
        todo = [(lo, hi)]
        while todo:
            f, t = todo.pop()
            if t - f < self.least:
                continue
            same, diff, a, b = self.wording(words[f:t])
            if same < self.least:
                continue
            todo += [(f, f + a), (f + b, t)]
            if b - a - same <= MAX_EXTRA * len(self.words):
                yield f + a, f + b, diff


class Matcher:
    def __init__(self, templates=tuple(TEMPLATES)):
        self.templates = [Template(*t) for t in templates]
        self.plain = zstandard.ZstdCompressor(level=3)
        self.gate: dict[str, list[int]] = {}
        for i, t in enumerate(self.templates):
            for w in t.gate:
                self.gate.setdefault(w, []).append(i)
        self.regex = "|".join(sorted(self.gate))

    def reductions(self, words: list[str], among: list[int]) -> list[tuple[int, float, int]]:
        """(compressed bytes that a template saves, their share, template), largest first."""
        raw = " ".join(words).encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(raw))
        saved = [(alone - len(self.templates[i].given.compress(raw)), i) for i in among]
        return sorted(((n, n / alone, i) for n, i in saved), key=lambda x: (-x[0], x[2]))

    def scan(self, text: str) -> list[dict]:
        """The notices of a text, none overlapping another. Of matches that overlap the one of whose bytes its template saves the largest
        share wins; the wording only confirms it, and decides between equal shares by the fewest differences."""
        words = words_of(text)
        at: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            for i in self.gate.get(w, ()):
                at.setdefault(i, []).append(k)
        blocks: dict[tuple[int, int], list[int]] = {}
        for i, places in at.items():
            for b in self.templates[i].blocks(places, len(words)):
                blocks.setdefault(b, []).append(i)
        found = {}
        for (lo, hi), among in blocks.items():
            for _, share, i in self.reductions(words[lo:hi], among):
                if share < MIN_REDUCTION:
                    continue
                for start, stop, diff in self.templates[i].matches(words, lo, hi):
                    if (i, start, stop) not in found:  # what it saves is ranked on the notice's own words
                        _, share, _ = self.reductions(words[start:stop], [i])[0]
                        found[i, start, stop] = (-share, len(diff), -len(self.templates[i].words), i, start, stop, diff, share)
        if not found:
            return []
        low = text.lower()
        ends, begins = [m.start() for m in re.finditer("\n", low)], [m.start() for m in WORD.finditer(low)]
        taken, out = bytearray(len(words)), []
        for _, _, _, i, start, stop, diff, share in sorted(found.values()):
            if not any(taken[start:stop]):
                taken[start:stop] = b"\1" * (stop - start)
                out.append({"licence": self.templates[i].licence, "line": bisect_right(ends, begins[start]), "start": start, "stop": stop, "reduction": round(share, 6), "differences": diff})
        return sorted(out, key=lambda r: r["start"])


def licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(id, licence, line, start, stop, reduction, differences, n_differences): one row per notice or clause found.

    start and stop are half-open numbers of words in the text, line that of the first of them, all from 0. A match holds
    MIN_WORDING of a template's words (all of a short one's) in order with at most MAX_EXTRA as many words between them. Every such match lies in a
    block of its template, because the blocks surround all gate words; which blocks go on is decided by compression. Null and
    empty texts have no notices; rows that repeat are scanned each; a null id keeps its rows. Extra columns are not read.
    """
    kind = pa.struct([("licence", pa.string()), ("line", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("reduction", pa.float64()), ("differences", pa.list_(pa.string()))])
    given, name = tuple(tuple(t) for t in templates), f"licences-{uuid.uuid4().hex}"

    @F.arrow_udf("array<struct<licence:string,line:long,start:long,stop:long,reduction:double,differences:array<string>>>")
    def scan(texts):
        m = once_per_worker(name, lambda: Matcher(given))
        gated = pc.match_substring_regex(texts, m.regex, ignore_case=True)
        return pa.array([m.scan(t.as_py()) if g.as_py() else [] for t, g in zip(texts, gated)], pa.list_(kind))

    src = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    return src.select("id", F.explode(scan.asNondeterministic()("text")).alias("f")).select("id", "f.*", F.size("f.differences").alias("n_differences"))


def op5_licence_scan(spark, sf_dir: str) -> DataFrame:
    """The licence notices of all documents."""
    return licences(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").withColumn("differences", F.array_join("differences", " "))
