"""The fits of the classifier and of the language shares against plain solvers, and rows that must not change them."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import langid, quality, vectors


def test_dual_coordinate_descent():
    """Margins equal those of projected gradient steps on the whole dual problem."""
    rng = np.random.default_rng(11)
    rows = [np.unique(rng.integers(0, 40, rng.integers(2, 9))).astype("i8") for _ in range(60)]
    labels = np.array([int(r.mean() + rng.normal(0, 6) > 19) for r in rows])
    model = quality.fit(rows, labels, rounds=3000)
    y, train = np.where(labels > 0, 1.0, -1.0), np.flatnonzero(np.arange(60) % 5 != 4)
    counts = np.ones((2, quality.PLACES))
    for i in train:
        counts[int(y[i] > 0), rows[i]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    wide = np.zeros((60, 41))
    for i, r in enumerate(rows):
        wide[i, r], wide[i, 40] = ratio[r] / np.sqrt(len(r)), 1.0  # the last column is the bias
    share = (y[train] > 0).mean()
    limit = np.where(y[train] > 0, 0.5 / share, 0.5 / (1 - share))
    signed = wide[train] * y[train, None]
    q = signed @ signed.T
    alpha, rate = np.zeros(len(train)), 1 / np.linalg.eigvalsh(q).max()
    for _ in range(60_000):
        alpha = np.clip(alpha + rate * (1 - q @ alpha), 0, limit)
    w = signed.T @ alpha
    assert (alpha > 0).sum() > 10 and np.abs(wide @ w - [model.margin(r) for r in rows]).max() < 1e-3


def test_language_shares():
    """Shares of a batch equal those of a plain loop for each document, and are the likeliest of two languages on a grid."""
    rng = np.random.default_rng(3)
    counts = np.array([1, 7, 40, 200, 3])
    likelihoods = np.exp(-rng.exponential(2, (counts.sum(), 4))).astype("f4")
    at = 0
    for n, got in zip(counts, langid.mixtures(likelihoods, counts), strict=True):
        own, share = likelihoods[at : at + n].astype("f8"), np.full(4, 0.25)
        at += n
        for _ in range(langid.STEPS):
            weight = own * share
            new = (weight / weight.sum(1, keepdims=True)).mean(0)
            done, share = np.abs(new - share).max() < langid.SMALL, new
            if done:
                break
        assert np.abs(got - share).max() < 5e-3
    two = np.exp(-rng.exponential(2, (300, 2))).astype("f4")
    grid = np.linspace(0.001, 0.999, 999)
    best = grid[np.log(two[:, :1] * grid + two[:, 1:] * (1 - grid)).sum(0).argmax()]
    assert abs(langid.mixtures(two, np.array([300]))[0, 0] - best) < 0.02


def test_rows_without_a_language_teach_nothing(spark):
    known = [(k, ("the green house by the sea " if k % 2 else "das gruene haus an der see ") * 5, "en" if k % 2 else "de") for k in range(20)]
    rows = spark.createDataFrame(known, "doc_id long, text string, lang string")
    more = rows.unionByName(spark.createDataFrame([(100 + k, "la casa verde al mare " * 9, None) for k in range(50)] + [(200, None, "en"), (201, "", "de")], rows.schema))
    a, b = langid.train(rows, F.lit(True)), langid.train(more, F.lit(True))
    assert a.languages == b.languages and np.allclose(a.logs, b.logs)
    assert {r["lang_pred"] for r in langid.identify(more.filter("doc_id = 200 or doc_id = 201"), b).collect()} == {"und"}


def test_mixed_lengths_in_many_cells(spark):
    """Vectors of three lengths over several cells: the links of brute force, none between lengths."""
    rng = np.random.default_rng(29)
    rows = []
    for dims in (16, 16, 16, 10, 1):
        for _ in range(90):
            x = rng.normal(size=dims)
            rows += [x, x + rng.normal(0, 0.03, dims)]
    labels = [int(k) for k in rng.integers(0, 2, len(rows) // 2)]
    table = [(k, x.tolist(), labels[k // 2]) for k, x in enumerate(rows)]
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_duplicates(spark.createDataFrame(table, "vec_id long, embedding array<double>, label int"), rows_per_cell=20).collect()}
    unit = [x / np.linalg.norm(x) for x in rows]
    want = {k: sum(j != k and len(u) == len(x) and labels[k // 2] == labels[j // 2] and float(u @ x) >= 0.93 for j, u in enumerate(unit)) for k, x in enumerate(unit)}
    assert sum(want.values()) > 500 and all(got[k] <= want[k] for k in want)
    assert sum(got.values()) >= 0.99 * sum(want.values())
