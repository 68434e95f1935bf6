"""License scans: passages against licence templates by Dice over word bigrams.

A text's passages are all its runs of words, so that a notice is found inside a line,
wrapped over lines or spread over paragraphs. Each is normalised (lower case, words of
letters and digits) to its set of word bigrams; two equal words in a row count as a
bigram like any other, a single word as the bigram of it and nothing. The Dice
coefficient of two sets is 2 |A and B| / (|A| + |B|). For a coefficient of at least d,
A must hold d / (2 - d) |B| of the template's bigrams and at most (2 / d - 2) |B|
others: a template of which the whole text holds fewer is pruned by one index from
bigram to templates. For the rest, the passages that start and end at the template's
bigrams are compared; any other passage has one inside that is no worse.

``scan`` returns one row per document with its matches: the best passage of each
licence found, and the best licence of all.

Defined cases: a null, empty or blank text matches nothing and is returned with
no match; ties go to the licence first by name, then to the earliest passage;
repeated rows are scanned each; a null doc_id is kept; columns other than doc_id
and text are ignored.
"""
from __future__ import annotations

import math
import re
from bisect import bisect

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
WORD = re.compile(r"[^\W_]+")

# Notices by which public licences are declared.
TEMPLATES = {
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS "
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."],
    "BSD-2-Clause": [
        "Released under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. This software is provided by the copyright holders and contributors "
        "\"as is\" and any express or implied warranties, including, but not limited to, the implied warranties of "
        "merchantability and fitness for a particular purpose are disclaimed."],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission."],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "https://www.boost.org/LICENSE_1_0.txt)"],
    "CC0-1.0": [
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work."],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "EPL-2.0": [
        "Licensed under the Eclipse Public License 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."],
    "Zlib": [
        "Released under the zlib License.",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
        "subject to the following restrictions"],
    "reserved": ["All rights reserved."],
}


def bigrams(text: str) -> frozenset[tuple[str, str]]:
    words = WORD.findall(text.lower())
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset((w, "") for w in words)


def dice(a: frozenset, b: frozenset) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def passages(text: str) -> list[tuple[int, int, str]]:
    """(first line, last line, text) of the distinct passages that can match a notice
    of ``TEMPLATES``: of those that start at a word, the best one for each notice."""
    found = Scanner(TEMPLATES, THRESHOLD).windows(text)
    return sorted({(first, last, passage) for _, _, first, last, passage in found})


class Scanner:
    def __init__(self, templates: dict[str, list[str]], threshold: float):
        self.threshold = threshold
        self.sets = [(name, bigrams(t)) for name, texts in sorted(templates.items()) for t in texts]
        self.by_bigram: dict[tuple[str, str], list[int]] = {}
        for k, (_, s) in enumerate(self.sets):
            for x in s:
                self.by_bigram.setdefault(x, []).append(k)
        d, sizes = threshold, [len(s) for _, s in self.sets]
        # a match shares so many of the template's bigrams at least, and holds so many others at most
        self.shared = [max(1, math.ceil(d / (2 - d) * n - 1e-9)) for n in sizes]
        self.others = [math.floor(2 * n / d - 2 * n + 1e-9) for n in sizes]
        self.known = self.by_bigram.keys()
        self.single = {x[0] for x in self.known if not x[1]}

    def best_ends(self, grams: list[tuple[str, str]], k: int):
        """(coefficient, first, last gram) of the best passage from each bigram that
        template k holds, if it matches. A best passage ends at such a bigram too,
        and none of its ends occurs in it again: without it, it were no worse."""
        s, least, spare = self.sets[k][1], self.shared[k], self.others[k]
        for first, head in enumerate(grams):
            if head not in s:
                continue
            seen, both, others, best, end = {head}, 1, 0, 0.0, first
            if least == 1:
                best = 2 / (1 + len(s))
            for last in range(first + 1, len(grams)):
                x = grams[last]
                if x == head:
                    break
                if x in seen:
                    continue
                seen.add(x)
                if x in s:
                    both += 1
                    if both >= least:
                        value = 2 * both / (both + others + len(s))
                        if value > best:
                            best, end = value, last
                else:
                    others += 1
                    if others > spare:
                        break
            if best >= self.threshold:
                yield best, first, end

    def windows(self, text: str | None):
        """(licence, coefficient, first line, last line, text) of the best matching
        passage from every word on, per template."""
        text = (text or "").lower()
        words = WORD.findall(text)
        grams = list(zip(words, words[1:]))
        count: dict[int, int] = {}
        for x in self.known & set(grams):
            for k in self.by_bigram[x]:
                count[k] = count.get(k, 0) + 1
        found = [(k, value, first, last + 1) for k in sorted(count) if count[k] >= self.shared[k]
                 for value, first, last in self.best_ends(grams, k)]
        if self.single:  # templates of one word
            found += [(k, 1.0, i, i) for i, w in enumerate(words) if w in self.single for k in self.by_bigram[w, ""]]
        if found:
            at = [m.span() for m in WORD.finditer(text)]
            ends = [m.start() for m in re.finditer("\n", text)]
            for k, value, first, last in found:
                a, b = at[first][0], at[last][1]
                yield self.sets[k][0], value, bisect(ends, a), bisect(ends, b - 1), text[a:b]

    def scan(self, text: str | None) -> list[dict]:
        best: dict[str, dict] = {}
        for name, value, first, last, _ in self.windows(text):
            old = best.get(name)
            if old is None or (-value, first, last) < (-old["dice"], old["first_line"], old["last_line"]):
                best[name] = {"license": name, "dice": value, "first_line": first, "last_line": last}
        return sorted(best.values(), key=lambda m: (-m["dice"], m["license"]))


MATCH = "array<struct<license:string,dice:double,first_line:int,last_line:int>>"


def scan(df: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license and dice of the best match (null if none), matches."""
    templates = templates or TEMPLATES

    def run(batches):
        scanner = Scanner(templates, threshold)
        kind = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("first_line", pa.int32()),
                                   ("last_line", pa.int32())]))
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([scanner.scan(t) for t in b.column(1).to_pylist()], kind)],
                names=["doc_id", "matches"])

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, f"doc_id long, matches {MATCH}") \
        .select("doc_id", F.get("matches", F.lit(0))["license"].alias("license"),
                F.get("matches", F.lit(0))["dice"].alias("dice"), "matches")
