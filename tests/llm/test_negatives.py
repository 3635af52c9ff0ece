"""Hard negatives against brute force: several clusters, hot cells, ties, repeats, broken rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives


def brute(rows, anchors, positives, n_negatives, percent, scale=256):
    fit = [(i, x, np.floor(scale * np.array(v, "f8")).astype("i8")) for i, v, x in rows if i is not None and x is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for a in sorted(anchors):
        own = [(str(x), v.tolist()) for i, x, v in fit if i == a]
        if not own:
            continue
        label, vector = min(own)
        scored = [(-int(v @ np.array(vector)), i, str(x)) for i, x, v in fit if i != a and len(v) == len(vector)]
        for s, p, _ in sorted(r for r in scored if r[2] == label)[:positives]:
            fits = sorted(r for r in scored if r[2] != label and percent[0] * -s <= 100 * -r[0] <= percent[1] * -s)
            out += [(a, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(fits[:n_negatives])]
    return sorted(out)


def found(df, *args, **more):
    return sorted(tuple(r) for r in negatives.hard_negatives(df, *args, **more).collect())


@pytest.mark.parametrize("kind", ["spread", "clusters", "one copy", "negative"])
def test_brute_force(spark, kind, monkeypatch):
    """Blocks of 64 rows, packs of 8 anchors, up to 12 clusters, so that several walks, cells and blocks meet."""
    monkeypatch.setattr(negatives, "BLOCK_VALUES", 512)
    monkeypatch.setattr(negatives, "PACK_ROWS", 8)
    monkeypatch.setattr(negatives, "PACKS_AT_ONCE", 2)
    rng = np.random.default_rng(3)
    n, d = 900, 8
    x = rng.normal(size=(n, d)) / 3
    if kind == "clusters":
        x = rng.normal(size=(10, d))[rng.integers(0, 10, n)] + x / 3
    if kind == "one copy":
        x[rng.random(n) < 0.4] = x[0]
    if kind == "negative":
        x = np.abs(x) * np.where(np.arange(n) % 2 == 0, 1, -1)[:, None]
    rows = [(int(i), [float(c) for c in v], int(rng.integers(0, 3))) for i, v in enumerate(x)]
    df = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], "vec_id long, embedding array<double>, label int, id string, v string, cell int")
    for percent in ((80, 100), (60, 110)):
        got = found(df, F.col("vec_id") % 10 == 0, positives=3, negatives=4, percent=percent, cluster_rows=8, most_clusters=12)
        want = brute(rows, range(0, n, 10), 3, 4, percent)
        assert got == want and (want or kind == "one copy")


def test_broken_rows(spark):
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [1.0, 0.4], 1), (1, [1.0, 0.4], 1), (2, [1.0, 0.4], 2), (3, [1.0, 0.4], 2), (3, [1.0, 0.4], 2), (4, [0.0, 0.0], 2), (5, [0.9, 0.4], None)]
    rows += [(None, [1.0, 0.4], 2), (6, None, 1), (7, [None, 1.0], 2), (8, [float("nan"), 1.0], 2), (9, [float("inf"), 1.0], 2), (11, [], 2), (12, [1.0, 0.4, 0.0], 2), (10, [1.0, 0.5, 0.1], 2), (20, [0.0, 0.0], 1), (30, None, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = brute(rows, [0, 10, 20, 30], 5, 5, (80, 100))
    assert found(df, F.col("vec_id") % 10 == 0) == want and len(want) > 3
    assert found(df.limit(0), F.col("vec_id") % 10 == 0) == [] and found(df, F.lit(False)) == [] and found(df.filter("label = 1"), F.lit(True)) == []


def test_walks_are_cut(spark):
    """On vectors in clusters a walk ends long before its list does."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(20, 32)) * 100
    rows = np.floor(centres[rng.integers(0, 20, 8000)] + rng.normal(size=(8000, 32)) * 10)
    anchors = rows[:40]
    unit_rows, norms = negatives.unit(rows)
    centre, radius = negatives.unit(anchors[:1])[0][0], np.pi / 8
    near = [i for i in range(40) if np.arccos(np.clip(negatives.unit(anchors)[0][i] @ centre, -1, 1)) < radius]
    bound = negatives.upper_bounds(unit_rows, norms, centre, radius)
    order = np.argsort(-bound, kind="stable")
    assert (np.linalg.norm(anchors[near], axis=1)[:, None] * bound[None] + 1 >= anchors[near] @ rows.T).all()
    best = [[negatives.Best(negatives._NONE, negatives._ALL, 5)] for _ in near]
    scored = negatives.walk(order, bound[order], rows, np.arange(8000), np.zeros(8000, "i8"), (anchors[near], np.array(near), np.zeros(len(near), "i8")), best, True)
    assert scored < 0.35 * len(near) * 8000
    for i, b in zip(near, best, strict=True):
        s = (rows @ anchors[i]).astype("i8")
        s[i] = -(10**15)
        assert b[0].ids.tolist() == np.lexsort((np.arange(8000), -s))[:5].tolist()
