"""Clusters by a predicate: folds that pass over many tiles, and bounds of posteriors."""

import math
import random

import pytest

from tidemark.operators import intervals as iv
from tidemark.plans.q_intervals import apart_by, contains
from tidemark.plans.q_reads import posterior_bounds


def plain(rows, joins):
    out, now = {}, {}
    for chrom, start, end, i in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3])):
        first, low, high = now.get(chrom, (None, 0, 0))
        if first is not None and joins(start, end, low, high):
            now[chrom] = first, min(low, start), max(high, end)
        else:
            now[chrom] = i, start, end
        out[i] = now[chrom][:2]
    return out


@pytest.mark.parametrize("name,joins", [("slack", apart_by(3)), ("contains", contains), ("short spans", lambda s, e, low, high: max(e, high) - min(s, low) <= 60)])
def test_folds(spark, name, joins):
    """Tiles of 25 positions; one interval reaches over many of them, so states pass along."""
    rng = random.Random(6)
    rows = [(rng.choice("ab"), s, s + rng.randrange(1, 40), f"r{k:03d}") for k in range(250) for s in [rng.randrange(2000)]] + [("a", 100, 900, "long"), ("b", 0, 5, "first"), ("b", 0, 5, "again")]
    df = spark.createDataFrame(rows, "chrom string, start long, end long, region_id string")
    got = {r["region_id"]: (r["cluster"], r["cluster_start"]) for r in iv.clusters(df, ["chrom"], "region_id", joins, tile=25).collect()}
    assert got == plain(rows, joins)
    assert iv.clusters(df.limit(0), ["chrom"], "region_id", joins).count() == 0


def test_posterior_bounds(spark):
    def grid(total, n, m):
        xs = list(range(m, total - n + m, 100))
        ll = [(m * math.log(x / total) if m else 0) + ((n - m) * math.log(1 - x / total) if n > m else 0) for x in xs]
        f = [math.exp(v - max(ll)) for v in ll]
        cum = [sum(f[: k + 1]) for k in range(len(f))]
        return tuple(next(x for x, c in zip(xs, cum, strict=True) if c >= share * cum[-1]) for share in (0.025, 0.975))

    for case in ((50_000, 3000, 400), (20_000, 1000, 0), (9000, 50, 49)):
        low, high = posterior_bounds(spark, *case)
        assert (low, high) == grid(*case) and low <= high
    assert posterior_bounds(spark, 10, 10, 3) == (None, None)
