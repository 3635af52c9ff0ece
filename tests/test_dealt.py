"""Scans and likelihoods of sequences that lie in one file: dealt to all tasks (before, one task did everything), several at once, each as if alone."""

import math

import numpy as np
import pytest

from tidemark.operators import models as m


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(12)
    seqs = ["".join(rng.choice(list("ACGTN"), n)) for n in (0, 2, 3, 4, 40, 41, 90, 150, 151, 700)]
    return seqs, {k: rng.dirichlet(np.ones(4) / 2, 3) + 1e-3 for k in (4, 1, 9)}


def strands(matrix, n):
    table = np.hstack([matrix, n(matrix)[:, None]])
    return table, table[::-1][:, [3, 2, 1, 0, 4]]


def test_scan(spark, data, monkeypatch):
    seqs, mats = data
    monkeypatch.setattr(m, "LETTERS", 100)
    df = spark.createDataFrame(list(enumerate(seqs)), "doc_id long, seq string").coalesce(1)
    out = m.scan_matrices(df, mats, 2.0, size=32)
    assert out.rdd.getNumPartitions() >= 4
    want = {}
    for wm, matrix in mats.items():
        both = strands(np.log2(matrix / 0.25), lambda x: x.mean(1))
        for doc, seq in enumerate(seqs):
            x = ["ACGTN".index(c) for c in seq]
            for i in range(len(x) - 2):
                plus, minus = (sum(t[j, x[i + j]] for j in range(3)) for t in both)
                if max(plus, minus) >= 2:
                    want[doc, wm, i] = ("+" if plus >= minus else "-", max(plus, minus))
    rows = out.collect()
    assert len(rows) == len(want) > 20 and {(r["doc_id"], r["wm"], r["pos"]): (r["strand"], r["score"]) for r in rows} == want


def test_likelihoods(spark, data, monkeypatch):
    seqs, mats = data
    monkeypatch.setattr(m, "MOTIFS", 2)
    monkeypatch.setattr(m, "ABREAST", 6)
    df = spark.createDataFrame(list(enumerate(seqs)), "doc_id long, seq string").coalesce(1)
    out = m.log_likelihoods(df, mats, [0.01, 0.2])
    assert out.rdd.getNumPartitions() >= 4
    rows = out.collect()
    got = {(r["doc_id"], r["wm"], r["prior"]): r["gain"] for r in rows}
    assert len(rows) == len(got) == len(seqs) * 6
    for (doc, wm, p), gain in got.items():
        x, both = ["ACGTN".index(c) for c in seqs[doc]], strands(mats[wm] / 0.25, lambda x: np.ones(len(x)))
        f = [1.0]
        for i in range(1, len(x) + 1):
            f.append((1 - p) * f[-1] + (p / 2 * sum(np.prod([t[j, x[i - 3 + j]] for j in range(3)]) for t in both) * f[i - 3] if i >= 3 else 0))
        want = math.log(f[-1]) if len(x) >= 3 else 0.0
        assert abs(gain - want) < 1e-9
