"""License scan by conditional compression.

Candidate blocks are lines with licence words and the words around them, over
line ends. A template is found
wherever enough of its words stand in a block in order; the wording from the
first to the last of them (lower case, single spaces) is compressed with
zstandard alone and with the template as raw dictionary, and the template is
confirmed if that saves bytes. A block can hold any number of notices.

Blocks repeat across millions of documents, so distinct blocks are grouped
first (a grouped minimum, no list of their documents is built) and each is
matched once; documents get the result by a join on the block.

Defined cases: null or empty text has no block and no row in ``find``;
repeated rows each get their rows; an empty table gives none; a line
with licence words that no template explains is reported with license "unknown"."""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import common as C

#: The usual notices and grants of common licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                     "the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
)
_NAMES = re.compile(r"licen[cs]e|copyright|redistribution[\W_]+and[\W_]+use|permission[\W_]+is[\W_]+hereby[\W_]+granted|"
                    r"free[\W_]+software|public[\W_]+domain|all[\W_]+rights[\W_]+reserved|spdx", re.IGNORECASE)
#: One of these is in the folded text wherever ``_NAMES`` matches.
_HINTS = ("licens", "licenc", "copyright", "redistribution", "hereby", "software", "domain", "reserved", "spdx")
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
#: Code points of a line on each side of its licence words at most, and
#: between words of a notice.
REACH = 400


def wording(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def width_of(templates) -> int:
    """Words of a block on each side of its lines: twice the longest template."""
    return 2 * max((len(wording(t)) for _, t in templates), default=0)


WIDTH = width_of(TEMPLATES)


def folded(text: str) -> str:
    """Lower case, with the few other characters that ``re.IGNORECASE`` takes
    for ASCII letters."""
    low = text.lower()
    return low if low.isascii() else low.replace("\u0307", "").replace("\u0131", "i").replace("\u017f", "s")


def lines(text: str) -> list[tuple[int, int]]:
    """Spans of lines with licence words; long lines are cut to REACH code
    points around the words, overlapping spans are joined."""
    low = folded(text)
    if not any(h in low for h in _HINTS):
        return []
    out: list[tuple[int, int]] = []
    for m in _NAMES.finditer(text):
        lo = max(text.rfind("\n", max(0, m.start() - REACH), m.start()) + 1, m.start() - REACH, 0)
        end = text.find("\n", m.end(), m.end() + REACH)
        hi = min(len(text), m.end() + REACH) if end < 0 else end
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def blocks(text: str, width: int = WIDTH) -> list[tuple[int, int]]:
    """The spans of ``lines`` and ``width`` words on each side of them, as a
    notice may be wrapped over lines; overlapping blocks are joined."""
    cores = lines(text)
    if not cores:
        return []
    at = [m.span() for m in _WORD.finditer(text)]
    starts, ends = [a for a, _ in at], [z for _, z in at]
    out: list[tuple[int, int]] = []
    for lo, hi in cores:
        before, after = bisect.bisect(ends, lo), bisect.bisect_left(starts, hi)  # words before it; first word after it
        lo = min(lo, starts[max(0, before - width)])
        hi = max(hi, ends[min(len(at), after + width) - 1])
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


class Template:
    """A template's words, and where they occur in a block's words."""

    def __init__(self, license: str, text: str, similarity: float):
        self.license, self.words = license, wording(text)
        self.need = max(1, math.ceil(similarity * len(self.words) - 1e-9))
        self.places: dict[str, list[int]] = {}
        for i, w in enumerate(self.words):
            self.places.setdefault(w, []).insert(0, i)  # last first, so that a word of the block is taken once

    def windows(self, words: list, at: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """First and last word of the shortest stretches, none overlapping,
        that hold ``need`` words of the template in order, each within REACH
        code points of the one before."""
        left = Counter(self.words)
        if sum(min(n, left[w]) for w, n in Counter(w for w in words if w in self.places).items()) < self.need:
            return []
        n, spare = len(self.words), len(self.words) - self.need
        # state[i][k]: latest (first, last) word of a match that ends with word i and skips k words before it
        state: list[list] = [[None] * (spare + 1) for _ in range(n)]
        found = []
        for j, w in enumerate(words):
            for i in self.places.get(w, ()):
                row = state[i]
                for k in range(spare + 1):
                    best = (j, j) if k == i else None
                    for d in range(min(i, k + 1)):
                        before = state[i - d - 1][k - d]
                        if before and at[j][0] - at[before[1]][1] <= REACH and (best is None or before[0] > best[0]):
                            best = (before[0], j)
                    row[k] = best or row[k]
                whole = [r[0] for r in row[:max(0, spare - (n - 1 - i) + 1)] if r and r[1] == j]
                if whole:
                    found.append((max(whole), j))
        out: list[tuple[int, int]] = []
        for a, z in sorted(found, key=lambda f: (f[1] - f[0], f)):
            k = bisect.bisect(out, (a, z))
            if (k == 0 or out[k - 1][1] < a) and (k == len(out) or out[k][0] > z):
                out.insert(k, (a, z))
        return out

    def align(self, words: list, lo: int, hi: int) -> list[tuple[int, int]]:
        """(template word, block word) pairs of the longest match in order
        within words lo to hi - 1; of equally long ones a short stretch."""
        row = [(0, -1)] * (hi - lo + 1)
        table = [row]
        for t in self.words:
            new = [(0, -1)]
            for j in range(lo, hi):
                best = max(row[j - lo + 1], new[-1])
                if words[j] == t:
                    c, first = row[j - lo]
                    best = max(best, (c + 1, first if c else j))
                new.append(best)
            row = new
            table.append(row)
        most = row[-1][0]
        i, j = len(self.words), min((j for j in range(len(row)) if row[j][0] == most), key=lambda j: j - row[j][1])
        pairs = []
        while table[i][j][0]:
            if table[i - 1][j] == table[i][j]:
                i -= 1
            elif table[i][j - 1] == table[i][j]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((i, lo + j))
        return pairs[::-1]

    def occurrences(self, words: list, at: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
        """The pairs of every place that holds the template."""
        out, low = [], 0
        found = self.windows(words, at)
        for k, (a, z) in enumerate(found):
            high = found[k + 1][0] if k + 1 < len(found) else len(words)
            lo, hi = a, z + 1
            while lo > low and at[a][0] - at[lo - 1][1] <= REACH:
                lo -= 1
            while hi < high and at[hi][0] - at[z][1] <= REACH:
                hi += 1
            out.append(self.align(words, lo, hi))
            low = out[-1][-1][1] + 1
        return out


class Matcher:
    """Finds templates in a block by wording and conditional compression."""

    def __init__(self, templates=TEMPLATES, similarity: float = 0.8):
        self.templates = [Template(n, t, similarity) for n, t in templates]
        params = zstandard.ZstdCompressionParameters.from_level(19, write_content_size=False, write_checksum=False)
        # cases and spaces are no difference in wording, so they cost no bytes either
        self.alone = zstandard.ZstdCompressor(compression_params=params)
        self.given = [zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(
            " ".join(t.words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for t in self.templates]

    def saved(self, words: list[str], i: int) -> int:
        raw = " ".join(words).encode()
        return len(self.alone.compress(raw)) - len(self.given[i].compress(raw))

    def ranked(self, words: list[str]) -> list[tuple[int, int]]:
        """(bytes saved, template) of the templates that make a block smaller,
        largest reduction first. A block is compressed in overlapping
        pieces, each notice whole in one, and the best piece counts: what
        a short notice saves isn't lost in a long block."""
        step = max((len(t.words) for t in self.templates), default=1) or 1
        pieces = [" ".join(words[a:a + 2 * step]).encode() for a in range(0, max(1, len(words) - step), step)]
        alone = [len(self.alone.compress(p)) for p in pieces]
        best = [(max(n - len(g.compress(p)) for n, p in zip(alone, pieces)), i) for i, g in enumerate(self.given)]
        return sorted((b for b in best if b[0] > 0), key=lambda b: (-b[0], b[1]))

    def match(self, block: str) -> list[tuple[int, int, str, int, float, list[str]]]:
        """(start, end, license, bytes saved, similarity, differences) of each
        notice in the block. The templates that make the block smaller
        (:meth:`ranked`) are aligned; a place is confirmed if its wording is
        similar enough and the template saves bytes on the words from its
        first to its last. The similarity is the share of the template's
        words found in order; differences are "-word" for words of the
        template that are missing and "+word" for words in between. Of
        notices that share words the one that saves most bytes stays; ties: most
        similar, then fewest words in between, then longest template, then
        first. Another license stays too if the words that are left
        confirm it. Lines with licence words but no notice are "unknown"."""
        at = [m.span() for m in _WORD.finditer(block)]
        words: list = [block[a:z].lower() for a, z in at]
        found = []

        def confirm(i, words):
            t = self.templates[i]
            for pairs in t.occurrences(words, at):
                inside = {j for _, j in pairs}
                first, last = pairs[0][1], pairs[-1][1]
                more = [f"+{own[j]}" for j in range(first, last + 1) if j not in inside]
                gain = self.saved(own[first:last + 1], i)
                if gain > 0:
                    have = {k for k, _ in pairs}
                    share = len(pairs) / len(t.words)
                    missing = [f"-{w}" for k, w in enumerate(t.words) if k not in have]
                    row = (at[first][0], at[last][1], t.license, gain, share, missing + more)
                    yield (gain, share, -len(more), len(t.words), -i), row, inside

        own = words
        for _, i in self.ranked(own):
            found += confirm(i, words)
        taken: dict[int, str] = {}
        out = []
        for key, row, inside in sorted(found, key=lambda f: f[0], reverse=True):
            rows = [(row, inside)]
            if not inside.isdisjoint(taken):
                if row[2] in {taken[j] for j in inside if j in taken}:
                    continue
                free = [w if row[0] <= a and z <= row[1] and j not in taken else None for j, (w, (a, z)) in enumerate(zip(own, at))]
                rows = [f[1:] for f in confirm(-key[4], free)]
            for r, ins in rows:
                out.append(r)
                taken.update(dict.fromkeys(ins, r[2]))
        for lo, hi in lines(block):
            if not any(f[1][0] < hi and lo < f[1][1] for f in found):
                rest = wording(block[lo:hi])
                out.append((lo, hi, "unknown", max((self.saved(rest, i) for i in range(len(self.given))), default=0), 0.0, []))
        return sorted(out)


def find(docs: DataFrame, templates=TEMPLATES, similarity: float = 0.8) -> DataFrame:
    """(doc_id, start, end, license, bytes_saved, similarity, differences):
    a row for every notice of every whole text, and for every line with
    licence words that holds none; offsets count code points."""
    src = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    width = width_of(templates)

    def cut(batches):
        for b in C.chunks(batches):
            out = [(i, s, t[s:e]) for i, t in enumerate(C.texts(b)) for s, e in blocks(t, width)]
            cols = list(zip(*out)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(np.array(cols[0], dtype=np.int64))), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.string())], names=["doc_id", "at", "block"])

    def match(batches):
        m = Matcher(templates, similarity=similarity)
        for b in batches:
            found = [[dict(zip(names, f)) for f in m.match(t)] for t in b.column("block").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("block"), pa.array(found, kinds)], names=["block", "found"])

    names = ["start", "end", "license", "bytes_saved", "similarity", "differences"]
    kinds = pa.list_(pa.struct(list(zip(names, [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.list_(pa.string())]))))
    cuts = materialize(C.map_arrow(src, cut, f"doc_id {kind}, at long, block string"), "blocks")
    distinct = cuts.select("block").distinct()
    matched = materialize(C.map_arrow(distinct, match, "block string, found array<struct<start: long, end: long, license: string, "
                                                       "bytes_saved: long, similarity: double, differences: array<string>>>"), "matched")
    rows = cuts.join(matched, "block").select("doc_id", "at", F.explode("found").alias("f"))
    return rows.select("doc_id", *[(F.col("at") + F.col(f"f.{c}")).alias(c) for c in names[:2]], *[f"f.{c}" for c in names[2:]])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_blocks, licenses) of every document that has rows in
    ``find``, and their number; licenses sorted, without "unknown"."""
    return find(docs).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_blocks"),
        F.array_sort(F.collect_set(F.when(F.col("license") != "unknown", F.col("license")))).alias("licenses"))
