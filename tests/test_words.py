"""Matrices summed by words of letters: the same as letter by letter."""

import numpy as np

from tidemark.operators import models as m


def test_words_are_their_letters():
    rng = np.random.default_rng(6)
    columns = {k: rng.normal(0, 2, (n, 5)) for k, n in enumerate((1, 3, 4, 5, 9, 16))}
    x = rng.integers(0, 5, 300)
    names, tables = m._word_tables(columns, np.add, "f8")
    total = sum(t[n] for t, n in zip(tables, m._words(x, tables), strict=True))
    for k, c in enumerate(columns.values()):
        at = np.arange(len(x) - len(c) + 1)
        assert np.allclose(total[at, k], sum(c[j, x[at + j]] for j in range(len(c))))
    assert names == list(columns)


def test_no_place_is_lost(monkeypatch):
    """Every place at or above the cutoff is among those that may reach it, on either strand, also at the seams of the blocks."""
    monkeypatch.setattr(m, "WORDS", 7)
    rng = np.random.default_rng(7)
    x = rng.integers(0, 5, 200)
    both = {(wm, s): rng.normal(0, 1, (8, 5)) for wm in (3, 5, 9) for s in (0, 1)}
    both[3, 0][2, 1] = -1e30
    score = {k: np.array([sum(c[j, x[i + j]] for j in range(8)) for i in range(193)]) for k, c in both.items()}
    cutoff = float(np.sort(score[5, 1])[-9])  # one place lies on it
    found = m._may_reach(x, m._word_tables(both, np.add, "f4"), cutoff)
    for k, wm in enumerate((3, 5, 9)):
        want = np.flatnonzero(np.maximum(score[wm, 0], score[wm, 1]) >= cutoff)
        assert set(want) <= set(found[k]) and len(found[k]) <= len(want) + 10
