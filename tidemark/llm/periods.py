"""Runs of words that repeat with a period: Lyndon arrays by Baier's grouping, Lyndon roots extended into runs."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lyndon_array(w: list[int]) -> list[int]:
    """Length of the longest Lyndon word that begins at each place of ``w``, in linear time but for the first sort of the letters.

    Phase one of Baier's suffix sorter. Groups of suffixes with one known Lyndon prefix are taken from the greatest to the least. Each member hangs its
    prefix on the nearest place to the left that no group has taken yet; places that get equally many of one prefix leave
    their old group for a new one right above it. When all groups are taken, a place's prefix is its longest Lyndon word.
    """
    n = len(w)
    members: list[list[int]] = []
    by: dict[int, list[int]] = {}
    for i, x in enumerate(w):
        by.setdefault(x, []).append(i)
    group = [0] * n
    for k, x in enumerate(sorted(by)):
        members.append(by[x])
        for i in by[x]:
            group[i] = k
    left, right, size = list(range(-1, n - 1)), list(range(1, n + 1)), [1] * n
    live = [len(x) for x in members]
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    at = len(members) - 1
    while at >= 0:
        if not live[at]:
            at = below[at]
            continue
        own = [i for i in members[at] if group[i] == at]
        length = size[own[0]]
        places: list[int] = []
        times: list[int] = []
        last = -1
        for i in own:  # ascending, so the left neighbour is never one of the group
            p, r = left[i], right[i]
            if r < n:
                left[r] = p
            if p < 0:
                continue
            right[p] = r
            if p == last:
                times[-1] += 1
            else:
                places.append(p)
                times.append(1)
                last = p
        if len(places) == 1:
            p = places[0]
            size[p] += times[0] * length
            moved = {(group[p], times[0]): places}
        else:
            moved = {}
            for p, m in zip(places, times, strict=True):
                size[p] += m * length
                moved.setdefault((group[p], m), []).append(p)
        for old, m in sorted(moved, reverse=True) if len(moved) > 1 else moved:
            some = moved[old, m]
            if len(some) == live[old]:
                continue  # the whole of what is left of the group
            new = len(members)
            members.append(some)
            live.append(len(some))
            live[old] -= len(some)
            for p in some:
                group[p] = new
            above.append(above[old])
            below.append(old)
            below[above[old]] = new
            above[old] = new
        at = below[at]
    return size


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning."""
    n, at, step = min(len(a), len(b)), 0, 16
    while at < n:
        end = min(n, at + step)
        differ = np.flatnonzero(a[at:end] != b[at:end])
        if len(differ):
            return at + int(differ[0])
        at, step = end, step * 2
    return n


def stretches(w: np.ndarray, least_length: int, least_exponent: int) -> list[tuple[int, int]]:
    """Bounds of pieces of ``w`` that hold all its runs whole.

    In a run each group of ``gram`` words, but for those at its end, comes again a period later. So a run lies in a stretch of
    groups that come again, and its period is bounded by the stretch's length. Groups that come again only farther on than
    that don't count, which may cut the stretch into shorter ones.
    """
    more = least_exponent - 1
    gram = max(1, min(max(least_length - q, more * q) for q in range(1, max(2, least_length))) - 1)
    if len(w) < gram + 1:
        return []
    key = w[: len(w) - gram + 1].astype("u8")
    for k in range(1, gram):
        key = key * np.uint64(0x9E3779B97F4A7C15) + w[k : len(w) - gram + 1 + k].astype("u8")
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return []
    again = np.full(len(key), len(w), "i8")
    again[order[:-1][same]] = (order[1:] - order[:-1])[same]
    on = again < len(w)
    while True:
        edge = np.flatnonzero(np.diff(np.concatenate(([0], on.view("i1"), [0]))))
        first, end = edge[::2], edge[1::2]
        most = (end - first + gram - 1) // more
        fits = on & (again <= np.repeat(np.concatenate(([0], np.stack((most, np.zeros_like(most)), 1).ravel())), np.diff(np.concatenate(([0], edge, [len(on)])))))
        if (fits == on).all():
            break
        on = fits
    return [(int(a), min(len(w), int(b) + gram - 1 + int(q))) for a, b, q in zip(first, end, most, strict=True)]


def runs(w: np.ndarray, least_length: int = 6, least_exponent: int = 4) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all maximal stretches with smallest period q and at least max(least_length, least_exponent * q) letters, sorted by start and period.

    Every run has a Lyndon root under one of the two orders of the letters that is the longest Lyndon word wherever it begins in the run, so at
    ``least_exponent - 1`` places a period apart. Such places are extended by common extensions to both sides, in the whole of ``w``.
    """
    found: dict[tuple[int, int], int] = {}
    for a, b in stretches(w, least_length, least_exponent):
        part = w[a:b]
        for letters in (part, -part):
            root = np.array(lyndon_array(letters.tolist()))
            i = np.arange(len(part))
            for k in range(1, least_exponent - 1):
                i = i[i + k * root[i] < len(part)]
                far = i + k * root[i]
                i = i[(root[far] == root[i]) & (part[far] == part[i])]
            inside: dict[int, int] = {}
            for at, q in zip((i + a).tolist(), root[i].tolist(), strict=True):
                if at + q <= inside.get(q, -1):
                    continue  # a later root of a run that is known
                end = at + q + _agree(w[at + q :], w[at:])
                start = at - _agree(w[:at][::-1], w[: at + q][::-1])
                if end - start >= 2 * q:
                    inside[q] = end
                    if end - start >= max(least_length, least_exponent * q):
                        found[start, q] = end - start
    return [(start, length, q) for (start, q), length in sorted(found.items())]


def periodic_runs(docs: DataFrame, least_length: int = 6, least_exponent: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, runs, collapsed`` of every document: its periodic runs of words, and its words without the repeats.

    Words are what lies between spaces and the characters 9 to 13, case kept. ``runs`` holds ``start, length, period`` of each run
    (see :func:`runs`) by start and period; ``collapsed`` the words, joined by one space, that no run holds behind its first period.

    Null, empty and blank texts have no words, no runs and an empty ``collapsed``. Repeated rows and null ids are handled each for itself; other columns
    are not carried; an empty table gives no rows. A text is handled whole, in time linear in its words but for two sorts.
    """

    def make():
        def function(columns):
            n_words, all_runs, collapsed = [], [], []
            for text in columns["text"]:
                words = WORD.findall(text or "")
                ids: dict[str, int] = {}
                w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), "i8", len(words))
                own = runs(w, least_length, least_exponent) if len(ids) < len(words) else []
                if own:
                    keep = np.ones(len(words), bool)
                    for start, length, q in own:
                        keep[start + q : start + length] = False
                    words = [words[i] for i in np.flatnonzero(keep)]
                n_words.append(len(w))
                all_runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                collapsed.append(" ".join(words))
            return {"id": columns["id"], "n_words": n_words, "runs": all_runs, "collapsed": collapsed}

        return function

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = map_rows(rows, f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string", make)
    return out.withColumnRenamed("id", id_col)
