"""License scan by conditional compression: zstandard with each template as a raw dictionary, then exact wording differences."""

from __future__ import annotations

import bisect
import difflib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

# Notices by which texts name their license, as the licenses' own guides word them.
TEMPLATES = {
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "Apache-2.0 (line)": "Licensed under the Apache License, Version 2.0.",
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "MIT (line)": "Released under the MIT License.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BSD (line)": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "GPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0 (line)": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0 (line)": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 (line)": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 (line)": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}
#: Words of a template that may be missing, added or replaced in a match, as a share of its words.
TOLERANCE = 0.25
#: Places that are judged together: a block without a match is not judged again for the places this close behind.
STRIDE = 16

WORD = re.compile(r"[\w.+:/-]*\w")


def words(text: str) -> list[str]:
    """Lower-case words, with the signs within them that licenses' names have."""
    return WORD.findall(text.lower())


def window(block: list[str], template: list[str]) -> tuple[int, int, list[tuple[str, str]]]:
    """The part of the block that the template's matching words span, and the ``missing, added`` words there.

    Matching words far out that cost more changes than they save (an "and" in the text around) don't belong to the span.
    """
    match = difflib.SequenceMatcher(None, template, block, autojunk=False)
    pieces = [m for m in match.get_matching_blocks() if m.size]
    if not pieces:
        return 0, 0, [(" ".join(template), "")]
    best = None
    for i, first in enumerate(pieces):
        cost = first.a
        for j in range(i, len(pieces)):
            if j > i:
                cost += max(pieces[j].a - pieces[j - 1].a - pieces[j - 1].size, pieces[j].b - pieces[j - 1].b - pieces[j - 1].size)
            end = pieces[j].b + pieces[j].size
            found = (cost + len(template) - pieces[j].a - pieces[j].size, first.b - end, first.b, end)
            best = found if best is None else min(best, found)
    _, _, start, end = best
    inner = difflib.SequenceMatcher(None, template, block[start:end], autojunk=False)
    differences = [(" ".join(template[a:b]), " ".join(block[start:end][c:d])) for tag, a, b, c, d in inner.get_opcodes() if tag != "equal"]
    return start, end, differences


class Seeds:
    """Where a text can begin to match a template, told by the templates' own runs of two words.

    A match with k changed words of a template's m leaves at least m - 1 - 2k of its runs of two words (a stretch of c changed words breaks at most
    c + 1 of them, an insertion one) within m + k words. If that bound says nothing, m - k of its words are left. So a place begins a stretch
    that holds as many runs (words) of one template as any match leaves it; no match is without one.
    """

    def __init__(self, worded: dict[str, list[str]], tolerance: float) -> None:
        self.pairs: dict[tuple[str, str], list[int]] = {}
        self.single: dict[str, list[int]] = {}
        self.need: list[tuple[int, int]] = []
        for k, own in enumerate(worded.values()):
            changes = math.floor(tolerance * len(own))
            left = len(own) - 1 - 2 * changes
            if left > 0:
                for pair in set(zip(own, own[1:])):
                    self.pairs.setdefault(pair, []).append(k)
            else:
                left = max(1, len(own) - changes)
                for word in set(own):
                    self.single.setdefault(word, []).append(k)
            self.need.append((left, len(own) + changes))

    def places(self, own: list[str]) -> list[int]:
        """Word numbers, ascending, of all places in ``own``."""
        hits: list[list[int]] = [[] for _ in self.need]
        for table, items in ((self.pairs, zip(own, own[1:])), (self.single, own)):
            if table:
                for i, item in enumerate(items):
                    if item in table:
                        for k in table[item]:
                            hits[k].append(i)
        found = set()
        for (need, reach), at in zip(self.need, hits, strict=True):
            found.update(first for first, last in zip(at, at[need - 1 :]) if last - first < reach)
        return sorted(found)


def finder(chosen: dict[str, str], tolerance: float):
    """A function from a text to its notices, for one task: ``block, license, reduction, n_changed, differences, matched`` in the text's order (see :func:`scan`)."""
    import zstandard as z

    raw = {name: z.ZstdCompressionDict(text.encode(), dict_type=z.DICT_TYPE_RAWCONTENT) for name, text in chosen.items()}
    options = {"level": 19, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
    plain = z.ZstdCompressor(**options)
    by_name = {name: z.ZstdCompressor(dict_data=d, **options) for name, d in raw.items()}
    worded = {name: words(text) for name, text in chosen.items()}
    counted = {name: Counter(own) for name, own in worded.items()}
    reach = math.ceil((1 + tolerance) * max(map(len, worded.values()), default=0))
    seeds = Seeds(worded, tolerance)
    known: dict[tuple, tuple | None] = {}

    def saving(block: str, names: list[str]) -> dict[str, float]:
        data = block.encode()
        alone = len(plain.compress(data))
        return {name: (alone - len(by_name[name].compress(data))) / alone for name in names}

    def judge(block: str, own: list[str]) -> tuple | None:
        there = Counter(own)
        # A template of which more words than the tolerance are nowhere in the block can't win.
        able = [name for name, c in counted.items() if c.total() - (c & there).total() <= tolerance * c.total()]
        saved = saving(block, able) if able else {}
        for name in sorted(saved, key=lambda name: (-saved[name], name)):
            start, end, differences = window(own, worded[name])
            changed = sum(max(len(a.split()), len(b.split())) for a, b in differences)
            if changed <= tolerance * len(worded[name]):
                return name, start, end, changed, [f"{a} -> {b}" for a, b in differences]
        return None

    def notices(text: str) -> list[tuple]:
        lower = text.lower()
        # Some letters become two in lower case, which may part a word.
        own = WORD.findall(lower) if len(lower) == len(text) else [w.lower() for w in WORD.findall(text)]
        places = seeds.places(own)
        if not places:
            return []
        spans = [m.span() for m in WORD.finditer(text)]
        lines = text.split("\n")
        begins = [0]
        for line in lines:
            begins.append(begins[-1] + len(line) + 1)
        found = []

        def best(a: int, b: int) -> tuple | None:
            block = text[spans[a][0] : spans[b - 1][1]]
            if block not in known:
                if len(known) > 10_000:
                    known.clear()
                known[block] = judge(block, own[a:b])
            if won := known[block]:
                return won[0], a + won[1], a + won[2], *won[3:]
            return None

        def search(low: int, high: int, places: list[int]) -> None:
            ahead = low
            for place in places:
                if place < max(low, ahead):
                    continue
                while low <= place:
                    a, b = max(low, place - reach), min(high, place + STRIDE + reach)
                    if not (won := best(a, b)):
                        ahead = place + STRIDE
                        break
                    if low < a or b < high:  # what the block cut off may belong to the match
                        won = best(max(low, won[1] - reach), min(high, won[2] + reach)) or won
                    won = best(won[1], won[2]) or won  # templates that differ in a word rank by the match alone
                    name, start, end, changed, differences = won
                    if low < start:
                        search(low, start, places[bisect.bisect_left(places, low) : bisect.bisect_left(places, start)])
                    first, last = (bisect.bisect_right(begins, spans[p][0]) - 1 for p in (start, end - 1))
                    lines_ = "\n".join(lines[first : last + 1]).strip()
                    found.append((first, name, saving(lines_, [name])[name], changed, differences, " ".join(own[start:end])))
                    low = end

        search(0, len(own), places)
        return found

    return notices


def scan(docs: DataFrame, templates: dict[str, str] | None = None, tolerance: float = TOLERANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, block, license, reduction, n_changed, differences, matched`` for each notice that words a license.

    Candidates begin where the text holds as many of a template's own runs of two words as any match leaves (:class:`Seeds`), and hold the
    words as far as the longest template reaches on either side. zstandard compresses a candidate plain and
    with each template as a raw dictionary; the templates are ranked by the share of bytes saved. From the best on, the
    exact differences in words decide: the first template within ``tolerance`` wins. What lies before and behind the
    match is judged again, so several notices in a line or a wrapped one amid text each have a row. ``block`` is
    the line (numbered from 0, empty ones too) in which the match begins, ``reduction`` the share of bytes saved on the lines it
    spans, ``matched`` its wording; ``differences`` pairs what is missing with what stands there instead.

    A template without words is refused, and a tolerance outside 0 to below 1. Null and empty texts have no rows; repeated rows and null ids are scanned each for itself; other columns are not carried. Whole texts.
    """
    chosen = TEMPLATES if templates is None else templates
    if not 0 <= tolerance < 1:
        raise ValueError(f"tolerance {tolerance} is not from 0 to below 1")
    for name, text in chosen.items():
        if not words(text):
            raise ValueError(f"the template {name!r} has no words")

    def make():
        notices = finder(chosen, tolerance)

        def function(columns):
            out = {k: [] for k in ("id", "block", "license", "reduction", "n_changed", "differences", "matched")}
            for doc, text in zip(columns["id"], columns["text"], strict=True):
                for row in notices(text or ""):
                    for name, value in zip(out, (doc, *row), strict=True):
                        out[name].append(value)
            return out

        return function

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind}, block int, license string, reduction double, n_changed int, differences array<string>, matched string"
    return map_rows(rows, schema, make).withColumnRenamed("id", id_col)
