"""Steps that follow distinct places or lines, not pairs or rows of equal places."""

import random

import numpy as np
import pandas as pd

from tidemark import sources
from tidemark.operators import intervals as iv
from tidemark.operators import models as m


def test_overlaps_by_place(spark):
    """Rows at equal places, nulls and empty intervals: the same pairs as without places, and lists are laid out only behind the join."""
    r = random.Random(5)
    rows = lambda n, wide: [(k, r.choice(["a", "b"]), s := r.randrange(60), s + r.randrange(wide), r.choice("+-")) for k in range(n)]
    a = spark.createDataFrame([*rows(120, 9), (900, None, 1, 5, "+")], "id long, chrom string, start long, end long, strand string")
    b = spark.createDataFrame([*rows(150, 30), (901, None, 1, 5, "+"), (902, "a", 3, 9, None)], "name long, chrom string, start long, end long, strand string")
    for how in ({}, {"least": 4}, {"least": 2, "stranded": True}):
        want, got = iv.overlaps(a, b, width=7, **how), iv.overlaps_by_place(a, b, **how)
        assert got.columns == want.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    copies = iv.overlaps_by_place(a, b.crossJoin(spark.range(50)).drop("id"))
    assert "Generate explode(_rows" in copies._jdf.queryExecution().executedPlan().toString()
    assert copies.count() == 50 * iv.overlaps(a, b).count()


def test_factor_is_cut_once_a_line(spark, tmp_path):
    """The line of a sheet isn't split again for each of its paths."""
    (tmp_path / "sheet").write_text("A;/x/s1.bed.gz,/x/s2.fq\nB;/y/s3.fa\n")
    rows = sources.read_samples(spark, str(tmp_path / "sheet"), rename="r")
    assert sorted(map(tuple, rows.collect())) == [("/x/s1.bed.gz", "A", "r_s1"), ("/x/s2.fq", "A", "r_s2"), ("/y/s3.fa", "B", "r_s3")]
    above = rows._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert "split(value" not in above


def test_profiles_step_together():
    """Profiles of several lengths fitted together are fitted as each by itself; one step of a start is that of the plain recursion."""
    rng = np.random.default_rng(3)
    covs = []
    for n in (100, 137, 420, 640, 990):
        d = np.zeros(n + 40)
        for s in rng.integers(0, n, n // 8):
            d[s : s + 36] += rng.integers(1, 4)
        covs.append(d[:n])
    places = [np.arange(1.0, len(c) + 1) for c in covs]
    together = m.fit_many([*places, np.array([1.0])], [*covs, np.zeros(1)], 60.0)
    assert together[-1] == [] and all(together[:-1])
    for x, c, found in zip(places, covs, together[:-1], strict=True):
        alone = m.fit_profile(pd.DataFrame({"bp": x, "cov": c}), 60.0).to_numpy()
        assert alone.shape == (len(found), 6) and np.allclose(alone, np.array(found), rtol=1e-9, atol=1e-9)
    (mu, sigma, rho), = m._mixtures([places[0]], [covs[0]], 2, 60.0, 3)
    best = -np.inf
    draws = np.random.default_rng(3)
    x, w = places[0], covs[0]
    for _ in range(m.STARTS):
        a, s, p, before = draws.uniform(1, 100, 2), np.full(2, (13.34 + 70.34) / 2), np.full(3, 1 / 3), -np.inf
        for _ in range(m.STEPS):
            dens = p[:2] * np.exp(-((x[:, None] - a) ** 2) / (2 * s**2)) / (np.sqrt(2 * np.pi) * s)
            total = dens.sum(1) + p[2] / 100
            r = dens / total[:, None] * w[:, None]
            a = np.clip((r * x[:, None]).sum(0) / r.sum(0), 1, 100)
            s = np.clip(np.sqrt((r * (x[:, None] - a) ** 2).sum(0) / r.sum(0)), 13.34, 70.34)
            p = np.append(r.sum(0), max(0.0, w.sum() - r.sum())) / w.sum()
            like = (w * np.log(total)).sum()
            if like - before < 1e-6 * abs(like):
                break
            before = like
        if like > best:
            best, want = like, (a, s, p)
    assert all(np.allclose(g, t, atol=1e-6) for g, t in zip((mu, sigma, rho), want, strict=True))


def test_regions_of_one_place_have_one_fit(spark, monkeypatch):
    """Regions at equal places are fitted once, and each has its rows."""
    from tidemark.plans import q_models as q

    sf = "/root/testdata/sf0.001"
    few = q.v.regions(spark, sf).limit(12)
    both = few.unionByName(few.withColumn("region_id", q.F.concat(q.F.lit("copy"), "region_id")))
    monkeypatch.setattr(q.v, "regions", lambda *_: both)
    places = q._place_fits(spark, sf).select("place").distinct().count()
    rows = q.mod5(spark, sf).toPandas().sort_values(["region_id", "mu"])
    met = sorted(set(rows["region_id"]))
    assert places and len(met) == 2 * places  # not every region has reads
    of = lambda name: rows[rows["region_id"] == name].drop(columns="region_id").to_numpy()
    assert all(np.array_equal(of(name), of("copy" + name)) for name in met if not name.startswith("copy"))


def test_lines_are_numbered_where_they_are_read(spark, tmp_path):
    """Lines of files read in many blocks, several in a task, have their numbers; nothing but the blocks' table is exchanged."""
    want = {}
    for k in range(3):
        want[k] = [f"{k}-{i}" + "x" * (i * 7 % 90) for i in range(400 + k)]
        (tmp_path / f"f{k}").write_text("\n".join(want[k]) + "\n")
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000b")
        spark.conf.set("spark.sql.files.openCostInBytes", "10b")
        lines = sources.numbered_lines(spark, str(tmp_path))
        assert {(r["file"], r["line"], r["value"]) for r in lines.collect()} == {(k, i, x) for k, rows in want.items() for i, x in enumerate(rows)}
        assert lines.count() == sum(map(len, want.values()))
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        for c, x in old.items():
            spark.conf.set(c, x)
