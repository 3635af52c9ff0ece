"""Recall of the inverted multi-index when links differ in one coordinate, in two, in all, or towards another cluster."""

import numpy as np
import pytest

from tidemark.llm import vectors


def planted(kind, rng, n_clusters=40, size=25, pairs=400, dims=32):
    """Clusters of unit vectors in labels of three sizes, and partners of some of them at a cosine just above the threshold."""
    centres = vectors.unit_rows(rng.normal(size=(n_clusters, dims)))
    x = vectors.unit_rows(np.repeat(centres, size, 0) + rng.normal(size=(n_clusters * size, dims)) * 0.12)
    own = rng.choice(len(x), pairs, replace=False)
    if kind == "one":
        way = np.eye(dims)[np.full(pairs, 5)]
    elif kind == "two":
        way = np.eye(dims)[rng.integers(0, 2, pairs) * 16 + 3]
    elif kind == "cluster":
        way = centres[rng.integers(0, n_clusters, pairs)] - x[own]
    else:
        way = rng.normal(size=(pairs, dims))
    way -= (way * x[own]).sum(1)[:, None] * x[own]
    way = vectors.unit_rows(way)
    cosine = rng.uniform(0.931, 0.945, pairs)[:, None]
    other = cosine * x[own] + np.sqrt(1 - cosine**2) * way
    labels = rng.choice(3, len(x), p=[0.7, 0.2, 0.1])
    return np.vstack([x, other]), np.concatenate([labels, labels[own]])


@pytest.mark.parametrize("kind", ["one", "two", "all", "cluster"])
@pytest.mark.parametrize("cells", [25, 256])
def test_recall(spark, kind, cells):
    rng = np.random.default_rng(cells)
    x, labels = planted(kind, rng)
    near = (x @ x.T >= 0.93) & (labels[:, None] == labels[None])
    np.fill_diagonal(near, False)
    df = spark.createDataFrame([(k, v.tolist(), int(label)) for k, (v, label) in enumerate(zip(x, labels, strict=True))], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_duplicates(df, rows_per_cell=len(x) / cells).collect()}
    links = near.sum()
    assert links >= 700 and sum(got.values()) >= 0.99 * links and all(got[k] <= near[k].sum() for k in got)


def test_reach_is_measured(spark):
    """Links along one direction that crosses no wall need no reach; without links the visit is complete."""
    rng = np.random.default_rng(1)
    full = float(np.sqrt(0.14)) + 1e-9
    x = vectors.unit_rows(rng.normal(size=(400, 8)))
    apart = spark.createDataFrame([(str(k), "a", v.tolist(), 1, k) for k, v in enumerate(np.eye(8))], "class string, label string, v array<double>, copies long, low long")
    books = (vectors.fit_codebook(x[:, :4], 4), vectors.fit_codebook(x[:, 4:], 4))
    assert vectors.measured_reach(apart, 8, books, 8, 0.93, 0.999) == pytest.approx(full)
    close = vectors.unit_rows(np.vstack([x, x + rng.normal(size=x.shape) * 1e-4]))
    df = spark.createDataFrame([(str(k), "a", v.tolist(), 1, k) for k, v in enumerate(close)], "class string, label string, v array<double>, copies long, low long")
    assert vectors.measured_reach(df, len(close), books, 8, 0.93, 0.9) < full
