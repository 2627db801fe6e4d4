"""License scans by conditional compression.

Sentences of a text that name a license matter are candidate blocks. A block is
compressed with each template as zstandard raw dictionary, long ones window by window; a
template's reduction is the most bytes it saves against no dictionary. Templates are
confirmed in the order of their reduction, down to MIN_SAVED bytes: words of template and
block are compared exactly around each place of its first mark (name, version number). A
match needs most of the template's words in order, all of its marks close together, no
word among or right after them that makes another license of it (nc, sa, lesser, another
version number), and no negation before it. A block may confirm several. Templates are
sentences of notices, whole notices among them, and SPDX identifiers.

Candidate blocks are found by one JVM pattern over whole texts; Python sees those
sentences only. A sentence runs on over line breaks (hard-wrapped notices, also with
comment signs before each line) and over abbreviations such as 'v.'; a blank line ends it.

Defined cases: null and empty texts have no block; a text may hold several licenses
(all are listed, the strongest first); equal reductions go to the smaller difference,
then to the earlier template; repeated sentences count each time.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import packed

# Wording of common license notices (public texts), id -> sentences.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("all-rights-reserved", "All rights reserved."),
    ("Apache-2.0", "Licensed under the Apache-2.0 license."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                     "or promote products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("ISC", "Released under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License v3.0."),
    ("GPL-3.0", "License: GNU GPL v3"),
    ("GPL-2.0", "License: GNU GPL v2"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                "or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
                 "License, or (at your option) any later version."),
    ("LGPL-2.1", "Licensed under the GNU LGPL v2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "Licensed under the GNU LGPL v3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or (at your option) any later version."),
    ("AGPL-3.0", "Licensed under the GNU AGPL v3."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *((k, f"SPDX-License-Identifier: {k}") for k in (
        "Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0",
        "MPL-2.0", "EPL-2.0", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0")),
)
#: words that tell a license from the others: those a template has must stand in the text close together
MARKS: dict[str, frozenset[str]] = {k: frozenset(v.split()) for k, v in {
    "Apache-2.0": "apache 2.0", "MIT": "mit granted", "BSD": "redistribution", "BSD-3-Clause": "bsd 3 clause neither endorse",
    "BSD-2-Clause": "bsd 2 clause", "ISC": "isc fee granted", "GPL-3.0": "gnu gpl 3 3.0", "GPL-2.0": "gnu gpl 2 2.0",
    "LGPL-2.1": "lesser lgpl 2.1", "LGPL-3.0": "lesser lgpl 3 3.0", "AGPL-3.0": "affero agpl 3 3.0", "EPL-2.0": "eclipse epl 2.0",
    "Unlicense": "unencumbered unlicense", "MPL-2.0": "mozilla mpl 2.0", "CC-BY-NC-4.0": "cc by nc 4.0", "CC-BY-SA-4.0": "cc by sa 4.0",
    "CC-BY-4.0": "cc by creative commons attribution 4.0", "CC0-1.0": "cc0 1.0",
    "all-rights-reserved": "all rights reserved"}.items()}
#: words that make another license of it, among the marks or right after them
_CC = frozenset("nc sa nd noncommercial sharealike noderivatives noderivs".split())
CONTRA: dict[str, frozenset[str]] = {
    "GPL-3.0": frozenset("lesser library affero".split()), "GPL-2.0": frozenset("lesser library affero".split()),
    "CC-BY-NC-4.0": _CC - {"nc"}, "CC-BY-SA-4.0": _CC - {"sa"}, "CC-BY-4.0": _CC,
    "all-rights-reserved": frozenset(("some", "no"))}
#: words that may stand between two version numbers of one license ('version 2 or version 3')
_LISTED = frozenset("or and either version versions ver v of the license".split())
_NEXT = frozenset("and or cc cc0 creative".split())
_TAIL = re.compile(r"[^\w\s]*")
_NUMBER = re.compile(r"\d+(?:\.\d+)*")
#: words added among the marks
SLACK = 6
#: a word before a match, with no mark of punctuation between, that denies it
_DENIED = re.compile(r"(?:\bnot|\bnever|\bnor|\bno longer|n['\u2019]t)(?:\s+[\w'\u2019-]+){0,2}\s*\Z", re.I)
CANDIDATE = (r"(?i)licen[sc]|rights\W+reserved|permission\W+(?:is\W+hereby|to\W+use)|redistribution\W+and\W+use"
             r"|public\W+domain|free\W+software|\bGNU\W+[AL]?GPL|neither\W+the\W+name")
_CANDIDATE = re.compile(CANDIDATE)
_CLAUSE = re.compile(r"[,;:()\[\]]|--")
_DENIAL = re.compile(r"not|never|nor|isn|aren|wasn|weren|don|doesn")
_SENTENCE = (r"(?i)\n[ \t\r\f]*\n\s*|\r[ \t\f]*\r\s*|(?<=[.!?])"
             r"(?<!\b(?:[a-z]|ver|vers|no|nr|inc|ltd|co|corp|al|cf|sec|dr|mr|mrs|ms|st)\.)\s+")
_LINE_START = re.compile(r"\s*[\r\n][ \t]*(?:(?:[#*;%>|!]+|//+|--+)(?=\s))?\s*")
_NAMED = re.compile(r"(?:apache|[al]?gpl|mpl|epl|cc0)-\d+(?:\.\d+)*(?:-only|-or-later)?|(?:bsd-)?\d-clause")
LEVEL = 12
MIN_COVER = 0.8
#: bytes a template must save to be compared word by word. The least that a confirmed license saved is 3
#: ('GNU GPL v3' alone) in the tests and 4 over the 129 different candidate blocks of the given tables;
#: tests hold the results against comparing every template
MIN_SAVED = 2
#: words of a block compressed at a time; windows overlap by half, so the longest template fits into one
WINDOW = 240


def _spans(text: str) -> list[tuple[str, int, int]]:
    """Lower-cased words with inner dots, hyphens kept ('4.0', 'free-form') and their
    places; 'cc-by-nc', 'apache-2.0', '3-clause' and 'v2.0' are several words."""
    out = []
    for m in re.finditer(r"[^\W_]+(?:[.\-][^\W_]+)*", text):
        word = m[0].lower()
        if word.startswith(("by-", "cc-")) or _NAMED.fullmatch(word):
            out += [(w, m.start(), m.end()) for w in word.split("-")]
        elif v := re.fullmatch(r"v\.?(\d.*)", word):
            out += [("v", m.start(), m.end()), (v[1], m.start(), m.end())]
        else:
            out.append((word, m.start(), m.end()))
    return out


def _wording(text: str) -> list[str]:
    return [w for w, _, _ in _spans(text)]


def _aligned(own: list[str], words: list[str], marks: frozenset[str]) -> list[tuple[int, int]]:
    """Pairs of equal words in order: as many marks, then as many words as possible, each early."""
    n, m = len(own), len(words)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        weight, row, below = 1000 if own[i] in marks else 1, best[i], best[i + 1]
        for j in range(m - 1, -1, -1):
            row[j] = weight + below[j + 1] if own[i] == words[j] else max(row[j + 1], below[j])
    out, i, j = [], 0, 0
    while i < n and j < m:
        if own[i] == words[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i][j + 1] >= best[i + 1][j]:
            j += 1
        else:
            i += 1
    return out


def _one_line(block: str) -> str:
    """A wrapped sentence on one line, without the comment signs its lines begin with."""
    return " ".join(_LINE_START.sub(" ", block).split())


def candidate_blocks(text: Column) -> Column:
    """Sentences of a text that match the candidate pattern, as they stand (with line breaks)."""
    found = F.filter(F.split(text, _SENTENCE), lambda s: s.rlike(CANDIDATE))
    return F.when(text.rlike(CANDIDATE), found).otherwise(F.array().cast("array<string>"))


class Scanner:
    """Templates as dictionaries; made once per task."""

    def __init__(self, templates=TEMPLATES, min_saved: int = MIN_SAVED):
        self.templates, self.min_saved = templates, min_saved
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.coders = []
        for _, text in templates:
            d = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.coders.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False))
        self.words = [_wording(t) for _, t in templates]
        self.marks = [MARKS.get(k, frozenset()).intersection(w) or frozenset(w)
                      for (k, _), w in zip(templates, self.words)]

    def _gain(self, i: int, data: bytes) -> float:
        return 1 - len(self.coders[i].compress(data)) / len(self.plain.compress(data))

    def ranked(self, block: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, float, int]]:
        """(bytes saved, size reduction, -template) of every template, the largest first: the best
        of the block's windows that hold a candidate phrase."""
        best = [(-1 << 30, 0.0, -i) for i in range(len(self.templates))]
        starts = range(0, max(len(spans) - WINDOW // 2, 1), WINDOW // 2)
        for at in starts:
            last = at + WINDOW >= len(spans)
            part = block[spans[at][1] if at and spans else 0:len(block) if last else spans[at + WINDOW - 1][2]]
            if len(starts) > 1 and not _CANDIDATE.search(part):
                continue
            data = part.encode()
            plain = len(self.plain.compress(data))
            for i, coder in enumerate(self.coders):
                saved = plain - len(coder.compress(data))
                best[i] = max(best[i], (saved, saved / plain, -i))
        return sorted(best, reverse=True)

    def _places(self, i: int, words: list[str]) -> Iterator[list[tuple[int, int]]]:
        """Alignments that confirm template ``i``, one for each place of its first mark."""
        own, marks = self.words[i], self.marks[i]
        at = [k for k, w in enumerate(own) if w in marks]
        first, last = at[0], at[-1]
        contra = CONTRA.get(self.templates[i][0], frozenset())
        for p in (p for p, w in enumerate(words) if w == own[first]):
            low, high = max(0, p - 2 * first - SLACK), p + 2 * len(own) + SLACK
            if sum(w in words[low:high] for w in own) < MIN_COVER * len(own):
                continue
            before = _aligned(own[:first][::-1], words[low:p][::-1], marks)
            pairs = [(first - 1 - a, p - 1 - b) for a, b in reversed(before)] + [
                (first + a, p + b) for a, b in _aligned(own[first:], words[p:high], marks)]
            place = dict(pairs)
            if len(pairs) < MIN_COVER * len(own) or any(k not in place for k in at):
                continue
            end = place[last]
            if end - p > last - first + SLACK:
                continue
            taken = set(place.values())
            added = [j for j in range(p, end) if j not in taken]
            after = []
            for j in range(end + 1, min(end + 4, len(words))):
                if words[j] in _NEXT:
                    break
                if j not in taken:
                    after.append(words[j])
            if contra.intersection([words[j] for j in added] + after):
                continue
            # another version number before the own one, unless both are listed
            numbers = [j for j in added if _NUMBER.fullmatch(words[j])]
            if any(not _NUMBER.fullmatch(words[k]) and words[k] not in _LISTED
                   for j in numbers for k in range(j, end)):
                continue
            yield pairs

    def scan(self, block: str) -> tuple[tuple, list[tuple]]:
        """The best template of a block (id, size reduction, share of the template found,
        template words missing, block words added, confirmed), and every confirmed license
        with its best template. A confirmed template is measured over the words it covers."""
        block = _one_line(block)
        spans = _spans(block)
        words = [w for w, _, _ in spans]
        order = self.ranked(block, spans)
        sure: dict[str, tuple] = {}
        for saved, _, i in order:
            if saved < self.min_saved:
                break
            i, own = -i, self.words[-i]
            for pairs in self._places(i, words):
                low, high = pairs[0][1], pairs[-1][1] + 1
                if _DENIED.search(_CLAUSE.split(block[:spans[low][1]])[-1]) or self._denied_inside(block, spans, pairs):
                    continue
                mine, theirs = {a for a, _ in pairs}, {b for _, b in pairs}
                missing = [w for a, w in enumerate(own) if a not in mine]
                added = [words[b] for b in range(low, high) if b not in theirs]
                end = _TAIL.match(block, spans[high - 1][2]).end()
                gain = self._gain(i, block[spans[low][1]:end].encode())
                rank = (round(gain, 6), -len(missing) - len(added), -i)
                name = self.templates[i][0]
                if name not in sure or rank > sure[name][0]:
                    sure[name] = (rank, (name, gain, 1 - len(missing) / len(own), missing, added, True))
        if sure:
            found = [m for _, m in sorted(sure.values(), key=lambda x: x[0], reverse=True)]
            return found[0], found
        best, top = None, max(saved for saved, _, _ in order)
        for saved, gain, i in order:
            if saved < top:
                break
            i, own = -i, self.words[-i]
            ops = difflib.SequenceMatcher(None, own, words, autojunk=False).get_opcodes()
            missing = [w for op, a, b, _, _ in ops if op != "equal" for w in own[a:b]]
            added = [w for op, _, _, c, d in ops if op != "equal" for w in words[c:d]]
            rank = (-len(missing) - len(added), -i)
            if best is None or rank > best[0]:
                best = (rank, (self.templates[i][0], gain, 1 - len(missing) / len(own), missing, added, False))
        return best[1], []

    @staticmethod
    def _denied_inside(block: str, spans: list[tuple[str, int, int]], pairs: list[tuple[int, int]]) -> bool:
        """Is a matched word, up to the first mark and its verb, preceded by an added denial
        ('is not licensed under')?"""
        taken = {b for _, b in pairs}
        low, high = pairs[0][1], pairs[-1][1]
        return any(b not in taken and b + 1 in taken and _DENIAL.fullmatch(block[spans[b][1]:spans[b][2]].lower())
                   for b in range(low, high))


_NAMES = ("license", "gain", "cover", "missing", "added", "confirmed")
_MATCH = "struct<license:string,gain:double,cover:double,missing:array<string>,added:array<string>,confirmed:boolean>"
_BLOCK = f"struct<best:{_MATCH},sure:array<{_MATCH}>>"


def scan(docs: DataFrame, text: str = "text", templates=TEMPLATES) -> DataFrame:
    """(_row, blocks, found): ``blocks`` (text, best template and confirmed matches of
    every candidate block, in order) and ``found`` (confirmed licenses, strongest first)."""
    @F.pandas_udf(f"array<{_BLOCK}>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(templates)
        seen: dict[str, dict] = {}
        for batch in batches:
            out = []
            for blocks in batch:
                row = []
                for block in blocks:
                    if block not in seen:
                        if len(seen) > 10_000:      # a memo of recent sentences, not a limit on results
                            seen.clear()
                        best, sure = scanner.scan(block)
                        seen[block] = {"best": dict(zip(_NAMES, best)), "sure": [dict(zip(_NAMES, m)) for m in sure]}
                    row.append(seen[block])
                out.append(row)
            yield pd.Series(out, dtype=object)

    rows = packed(docs).withColumn("sentences", candidate_blocks(F.coalesce(F.col("_row")[text], F.lit(""))))
    some = F.size("sentences") > 0
    blocks = F.when(some, judge(F.col("sentences"))).otherwise(F.array().cast(f"array<{_BLOCK}>"))
    judged = rows.withColumn("b", blocks).select("_row", F.arrays_zip(
        F.col("sentences").alias("text"), F.col("b.best").alias("match"), F.col("b.sure").alias("matches")).alias("blocks"))
    sure = F.flatten(F.col("blocks.matches"))
    ranked = F.array_sort(F.transform(sure, lambda m: F.struct((-m["gain"]).alias("g"), m["license"].alias("l"))))
    return judged.withColumn("found", F.array_distinct(F.transform(ranked, lambda x: x["l"])))
