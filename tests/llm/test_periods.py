"""Lyndon arrays, runs and collapsed texts against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import periods, queries


def brute_lyndon(w):
    out = []
    for i in range(len(w)):
        j = i + 1
        while j < len(w) and w[j:] > w[i:]:
            j += 1
        out.append(j - i)
    return out


def brute_runs(w, least, exponent):
    got = {}
    for q in range(1, len(w)):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            end = i + q
            if i > s and end - s >= max(least, exponent * q) and not any(b <= s and end <= b + n for (b, p), n in got.items() if p < q):
                got[s, q] = end - s
            i += i == s
    return [(s, n, q) for (s, q), n in sorted(got.items())]


def words(rng):
    n, letters = rng.randrange(60), rng.choice([1, 2, 2, 3, 6])
    w = [rng.randrange(letters) for _ in range(n)]
    if rng.random() < 0.6 and n > 4:
        p, a = rng.randrange(1, 9), rng.randrange(n)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_lyndon_arrays():
    rng = random.Random(3)
    for _ in range(1500):
        w = words(rng)
        assert periods.lyndon_array(w) == brute_lyndon(w)
    n = 50_000  # linear: one letter, rising, falling letters
    assert periods.lyndon_array([0] * n) == [1] * n and periods.lyndon_array(list(range(n))) == list(range(n, 0, -1)) and periods.lyndon_array(list(range(n, 0, -1))) == [1] * n


@pytest.mark.parametrize("least,exponent", [(6, 4), (2, 2), (8, 3), (1, 5)])
def test_runs(least, exponent):
    rng = random.Random(least)
    for _ in range(1500):
        w = words(rng)
        assert periods.runs(np.array(w, "i8"), least, exponent) == brute_runs(w, least, exponent)


def test_long_runs():
    """A period of hundreds of words inside a long text, and runs inside a run's period."""
    rng = np.random.default_rng(1)
    unit = np.concatenate([rng.integers(0, 1000, 300), np.tile([5, 6], 20), rng.integers(0, 1000, 300)])
    w = np.concatenate([rng.integers(2000, 3000, 5000), np.tile(unit, 5)[:-13], rng.integers(2000, 3000, 5000)])
    got = periods.runs(w)
    long = [r for r in got if r[2] == 640]
    assert long == [(5000, 640 * 5 - 13, 640)] and sorted(r[2] for r in got).count(2) == 5
    assert got == brute_runs(w[4990:8200].tolist(), 6, 4) or [(s - 4990, n, q) for s, n, q in got] == brute_runs(w[4990:8200].tolist(), 6, 4)


def test_rows(spark):
    rows = [(1, "a b a b a b a b c"), (1, "a b a b a b a b c"), (None, "x x x x x x"), (2, None), (3, ""), (4, " \t\n\x0b "), (5, "no run here"), (6, "  y z " * 4), (7, "q " * 200_000)]
    df = spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], "doc_id long, text string, id string, runs int, collapsed string")
    got = sorted(((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periods.periodic_runs(df).collect()))
    assert got == [
        (0, 6, [(0, 6, 1)], "x"), (1, 9, [(0, 8, 2)], "a b c"), (1, 9, [(0, 8, 2)], "a b c"), (2, 0, [], ""), (3, 0, [], ""), (4, 0, [], ""), (5, 3, [], "no run here"),
        (6, 8, [(0, 8, 2)], "  y z"), (7, 200_000, [(0, 200_000, 1)], "q"),
    ]
    assert periods.periodic_runs(df.limit(0)).count() == 0


def test_planted_ends(spark):
    """The query's own planted ends: words from a on repeat with period p."""
    import zlib

    rows = [(i, " ".join(f"w{i}_{k}" for k in range(1 + i % 50))) for i in range(300)] + [(300, None), (301, "")]
    got = {r["doc_id"]: r["text"] for r in queries._periodic(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        h, w = zlib.crc32(str(i).encode()), (text or "").split()
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(w[k] if k < a else w[a + (k - a) % p] for k in range(n))
        assert got[i] == text
    nothing = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    assert queries._periodic(nothing).select(F.col("text")).first()[0] == "a b"
