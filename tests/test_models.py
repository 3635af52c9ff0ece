"""Fits recover planted parameters, shuffles keep their strata, worked examples of the sequence functions."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidemark.functions import sequence as sq
from tidemark.operators import intervals as iv
from tidemark.operators import models as m


def test_mixture_recovers_its_parameters(spark):
    rng = np.random.default_rng(2)
    s = rng.uniform(0.02, 0.1, 4000)
    x = rng.normal(0.3, np.sqrt(0.2 + s))
    x[:400] = rng.uniform(-4, 6, 400)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "s": s}))
    fit = m.fit_mixture(df)
    assert abs(fit["mu"] - 0.3) < 0.06 and abs(fit["q"] - 0.2) < 0.06 and abs(fit["rho"] - 0.1) < 0.06
    z = m.z_scores(df, fit).filter("x > 3").agg(F.min("z"), F.min("post")).first()
    assert z[0] > 3 and z[1] > 0.9


def test_fit_sums_alike(spark):
    """The steps over a short list on the driver and those over the cached list end at the same parameters; nulls take no part."""
    rng = np.random.default_rng(4)
    f, b = rng.poisson(6, 3000) + 1, rng.poisson(6, 3000) + 1
    rows = pd.DataFrame({"x": np.log(f / b), "s": 1 / (f + b)})
    rows.loc[:150, "x"] = np.round(rng.uniform(-2, 3, 151), 1)
    df = spark.createDataFrame([(float(x), float(s)) for x, s in rows.to_numpy()] + [(None, 0.1), (0.2, None)], "x double, s double")
    here, there = m.fit_mixture(df), m.fit_mixture(df, histogram=0)
    assert all(abs(here[k] - there[k]) <= 1e-9 * max(1, abs(there[k])) for k in there) and here.keys() == there.keys()
    assert m.fit_mixture(df.limit(0)) == m.fit_mixture(df.limit(0), histogram=0)


def test_no_uniform_share(spark):
    """Without a uniform share nothing is enriched, however far off; rows of one normal give the same fit on both paths."""
    far = spark.createDataFrame([(0.0, 0.01), (900.0, 0.01)], "x double, s double")
    assert [r["post"] for r in m.z_scores(far, {"rho": 0.0, "mu": 0.0, "q": 0.01, "range": 900.0}).collect()] == [0.0, 0.0]
    x = np.round(np.random.default_rng(8).normal(0, 0.1, 500), 2)
    df = spark.createDataFrame([(float(v), 0.0001) for v in x], "x double, s double")
    here, there = m.fit_mixture(df), m.fit_mixture(df, histogram=0)
    assert all(abs(here[k] - there[k]) <= 1e-9 for k in there)


def test_profile_finds_two_peaks():
    bp = np.arange(1, 601)
    cov = 40 * np.exp(-((bp - 150) ** 2) / (2 * 20**2)) + 25 * np.exp(-((bp - 430) ** 2) / (2 * 20**2)) + 1
    found = m.fit_profile(pd.DataFrame({"bp": bp, "cov": cov}), fragment=60)
    assert any(abs(mu - 150) < 10 for mu in found["mu"]) and any(abs(mu - 430) < 10 for mu in found["mu"])
    assert m.fit_profile(pd.DataFrame({"bp": [1], "cov": [0.0]}), 60).empty


def test_peaks_are_read_off_the_curve():
    """A worked example: one component of share 0.8 on a flat fifth of 100 positions, and a profile that is off by a known amount."""
    x = np.arange(1.0, 101)
    mu, sigma, rho = np.array([50.0]), np.array([10.0]), np.array([0.8, 0.2])
    curve = 0.8 * np.exp(-((x - 50) ** 2) / 200) / (np.sqrt(2 * np.pi) * 10) + 0.002
    (p, m_, s_, height, rmsd, uniform), = m.peaks_of(x, curve, 500.0, mu, sigma, rho, [(0.8, 50.0, 10.0)])
    assert abs(height - 500 * 0.8 / (math.sqrt(2 * math.pi) * 10)) < 1e-9 and abs(uniform - 1.0) < 1e-12 and rmsd < 0.02
    far = m.peaks_of(x, curve + 0.5 * curve.max(), 500.0, mu, sigma, rho, [(0.8, 50.0, 10.0)])
    assert abs(far[0][4] - 0.5) < 0.02
    two = m.peaks_of(x, curve, 500.0, np.array([45.0, 55.0]), np.array([5.0, 5.0]), np.array([0.4, 0.4, 0.2]), [(0.8, 50.0, 5.0)])
    between = 2 * 0.4 * math.exp(-0.5) / (math.sqrt(2 * math.pi) * 5)
    assert abs(two[0][3] - 500 * between) < 1e-9  # the mixture's height between two components, not that of one normal


def test_fitted_profiles_beat_a_plain_fit():
    """The fit's likelihood is no worse than that of plain expectation-maximisation from the true parameters."""
    rng = np.random.default_rng(4)
    bp = np.arange(1, 481)
    true = 300 * np.exp(-((bp - 120) ** 2) / (2 * 20.0**2)) + 150 * np.exp(-((bp - 350) ** 2) / (2 * 25.0**2)) + 10
    cov = rng.poisson(true).astype("f8")
    found = m.fit_profile(pd.DataFrame({"bp": bp, "cov": cov}), 60).sort_values("mu")
    assert len(found) == 2 and np.allclose(found["mu"], [120, 350], atol=3) and np.allclose(found["sigma"], [20, 25], atol=3)
    assert np.allclose(found["height"], [300, 150], rtol=0.1) and np.allclose(found["uniform"], 10, rtol=0.3) and (found["rmsd"] < 0.05).all()
    share = found["rho"].to_numpy()
    assert np.allclose(share * cov.sum() / (np.sqrt(2 * np.pi) * found["sigma"]), found["height"], rtol=0.05)


def test_beta_is_a_root(spark):
    rng = np.random.default_rng(1)
    rows = [(k % 2, float(rng.gamma(1.0 + k % 2)), float(rng.integers(50, 400))) for k in range(200)]
    beta = {r["wm"]: r["beta"] for r in m.fit_beta(spark.createDataFrame(rows, "wm long, n double, len double")).collect()}
    for wm, b in beta.items():
        n, size = (np.array([r[i] for r in rows if r[0] == wm]) for i in (1, 2))
        slope = lambda b: (size / (n + b * size)).sum() - len(n) * size.sum() / (n.sum() + b * size.sum())  # noqa: B023, E731
        assert slope(b * 0.99) * slope(b * 1.01) <= 0 or b > 900


def test_scan_finds_a_planted_site(spark):
    matrix = np.array([[0.97, 0.01, 0.01, 0.01], [0.01, 0.97, 0.01, 0.01], [0.01, 0.01, 0.97, 0.01], [0.01, 0.01, 0.01, 0.97], [0.97, 0.01, 0.01, 0.01]])
    df = spark.createDataFrame([(1, "TTTTACGTATTTT"), (2, "GGTACGTGG"), (3, "NN"), (4, None)], "doc_id long, seq string")
    got = {(r["doc_id"], r["pos"], r["strand"]) for r in m.scan_matrices(df, {0: matrix}, 8.0).collect()}
    assert got == {(1, 3, "-"), (1, 4, "+"), (2, 2, "-")}
    cut = {(r["doc_id"], r["pos"], r["strand"]) for r in m.scan_matrices(df, {0: matrix}, 8.0, size=3).collect()}
    assert cut == got  # chunks shorter than the matrix change nothing
    gain = {r["doc_id"]: r["gain"] for r in m.log_likelihoods(df.limit(2), {0: matrix}, [0.05]).collect()}
    assert gain[1] > 0.5


def test_likelihood_matches_a_plain_recursion(spark):
    rng = np.random.default_rng(2)
    mats = {k: rng.dirichlet(np.ones(4), 3) for k in range(2)}
    seq = "".join(rng.choice(list("ACGTN"), 150))
    got = {(r["wm"], r["prior"]): r["gain"] for r in m.log_likelihoods(spark.createDataFrame([(1, seq)], "doc_id long, seq string"), mats, [0.01, 0.2]).collect()}

    def plain(x, odds, p):
        f = [1.0]
        for i in range(1, len(x) + 1):
            f.append((1 - p) * f[-1] + (p / 2 * sum(np.prod([s[j, x[i - 3 + j]] for j in range(3)]) for s in odds) * f[i - 3] if i >= 3 else 0))
        return math.log(f[-1])

    x = ["ACGTN".index(c) for c in seq]
    for (k, p), gain in got.items():
        odds = np.hstack([mats[k] / 0.25, np.ones((3, 1))])
        turned = odds[::-1][:, [3, 2, 1, 0, 4]]
        assert abs(gain - plain(x, (odds, turned), p)) < 1e-9
    assert len(got) == 4


def test_uniform_matrices_leave(spark):
    from tidemark.plans.q_scores import not_uniform

    rows = [(1, k, 2.0, 2.0, 2.0, 2.0) for k in range(3)] + [(2, 0, 1.0, 1.0, 1.0, 1.0), (2, 1, 1.0, 1.0, 1.0, 1.5)]
    assert [tuple(r) for r in not_uniform(spark.createDataFrame(rows, "wm long, pos int, a double, c double, g double, t double")).collect()] == [(2, 2)]


def test_adaptor_variants():
    from tidemark.functions import sequence as sq

    assert sq.variants("AC", 1) == ["AC", "AA", "AG", "AN", "AT", "CC", "GC", "NC", "TC"]
    with_gaps = sq.variants("ACGTAC", 1, indels=True, beyond="T")
    assert "ACTACT" in with_gaps and "ACNGTA" in with_gaps and "CGTACT" not in with_gaps
    assert "TACTAC" in sq.variants("ACGTAC", 1, indels=True, five=True, beyond="T")


def test_sweeps_do_not_depend_on_tiles(spark):
    import random

    from tidemark.operators import intervals as iv

    rng = random.Random(9)
    rows = [(rng.choice("xy"), a := rng.randint(0, 3000), a + rng.randint(1, 40), f"r{k}") for k in range(400)]
    df = spark.createDataFrame(rows, "chrom string, start long, end long, id string")
    same = lambda f: len({tuple(sorted(map(tuple, f(t).collect()), key=repr)) for t in (50, 700, 10**6)}) == 1
    assert same(lambda t: iv.merged(df, ["chrom"], 1, t)) and same(lambda t: iv.gaps(df, tile=t)) and same(lambda t: iv.covered(df, ["chrom"], "id", t))
    at = df.select("chrom", "id", ((df.start + df.end) / 2).cast("long").alias("middle"))
    left, right = at.filter("id < 'r2'"), at.filter("id >= 'r2'")
    assert same(lambda t: iv.nearest(left, right, "id", "id", tile=t))
    assert same(lambda t: iv.nearest_sides(left.withColumnRenamed("id", "region_id"), right.withColumnRenamed("id", "gene"), 3, tile=t))


def test_touching_and_overlapping(spark):
    a = spark.createDataFrame([("c", 0, 10), ("c", 10, 20), ("d", 0, 5000)], "chrom string, start long, end long")
    b = spark.createDataFrame([("c", 5, 10), ("c", 20, 30), ("d", 4999, 5001)], "chrom string, start long, end long")
    got = sorted((r["chrom"], r["start"], r["r_start"]) for r in iv.overlaps(a, b).collect())
    assert got == [("c", 0, 5), ("d", 0, 4999)]
    assert sorted((r["chrom"], r["start"], r["end"], r["n"]) for r in iv.merged(a, ["chrom"]).collect()) == [("c", 0, 20, 2), ("d", 0, 5000, 1)]


def test_running_total_is_global(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 7).alias("v"))
    rows = iv.running_total(df, "v", [F.desc("id")], "t", parts=7).orderBy(F.desc("id")).collect()
    assert [r["t"] for r in rows] == list(np.cumsum([r["v"] for r in rows]))


def test_sequence_functions(spark):
    seq = "AAACCTTTGTTTCCCATTCTGTTACCTNCTNCT"
    qual = "IIHHIIHIIIIIIHHIIHIGIIIEIII#DI#II"
    df = spark.createDataFrame([(1, seq, qual)], "read_id long, seq string, qual string")
    row = sq.quality_trim(df, lambda q: q.cast("double")).first()
    assert row["trimmed"] == seq and row["tq"] == qual
    one = df.select(
        sq.reverse_complement(F.lit("AACGTN")).alias("rc"), sq.trim_full(F.lit("TTTGATCAXX"), "GATC", 1).alias("cut"), sq.trim_tail(F.lit("TTTGAT"), "GATCA", 4).alias("tail"),
        sq.tag_code(F.lit("ACGT")).alias("short"), sq.tag_code(F.lit("A" * 20)).alias("poor"), sq.tag_code(F.lit("ACGTTGCAATCCGGATTACA")).alias("fine"),
        sq.restore(F.lit("ACGTACGT"), sq.describe(F.lit("ACGAACGG"), F.lit("ACGTACGT"))).alias("back"), sq.describe(F.lit("ACGAACGG"), F.lit("ACGTACGT")).alias("d"),
    ).first()
    assert tuple(one) == ("NACGTT", "TTT", "TTT", 1, 3, 0, "ACGAACGG", "3M A 3M G")


def test_elbow_of_a_kinked_curve():
    x = np.linspace(0, 10, 300)
    y = np.where(x < 4, 9 - 2 * x, 1 - 0.02 * (x - 4))
    assert 3.5 < m.elbow(x, y, 3.0) < 5.5
    assert m.elbow(np.array([1.0]), np.array([1.0]), 3.0) == 3.0


def test_forward_selection_matches_brute_force(spark):
    rng = np.random.default_rng(12)
    n, beta = 60, 0.05
    size, fg = rng.integers(20, 200, n), rng.random(n) < 0.4
    sites = {(i, w): float(rng.random()) for i in range(n) for w in range(5) if rng.random() < (0.6 if fg[i] and w < 2 else 0.1)}
    regions = spark.createDataFrame([(f"r{i}", int(size[i]), bool(fg[i])) for i in range(n)], "region_id string, len long, fg boolean")
    sums = spark.createDataFrame([(f"r{i}", w, x) for (i, w), x in sites.items()], "region_id string, wm long, n double")

    def score(motifs):
        own = np.array([sum(sites.get((i, w), 0.0) for w in motifs) for i in range(n)])
        return float((np.log(own + beta * size)[fg] - np.log(own.sum() + beta * size.sum()) + np.log(n)).sum())

    want, left = [], list(range(5))
    while left:
        best = max(left, key=lambda w: (score([*(x for x, _ in want), w]), -w))
        value = score([*(x for x, _ in want), best])
        if want and value - want[-1][1] < 0.5:
            break
        want.append((best, value))
        left.remove(best)
    got = m.forward_selection(sums, regions, beta, 0.5, 8)
    assert len(want) > 1 and [w for w, _ in got] == [w for w, _ in want] and np.allclose([x for _, x in got], [x for _, x in want])


def test_elbow_falls_back():
    x = np.linspace(0, 10, 200)
    flat = np.zeros(200)
    assert m.elbow(x, flat, 3.0) == 3.0 and m.elbow(x, flat, 9.0, clamp=(2.0, 5.0)) == 5.0
    assert abs(m.elbow(x, flat, None) - (x.mean() + 3 * x.std())) < 1e-12
    at = np.linspace(0, 3, 400)
    y = np.where(at < 1.5, 9 - 4 * at, 3 - 0.02 * (at - 1.5))
    assert math.exp(1.4) < m.elbow(np.exp(at), y, 3.0, size=1000, log_x=True) < math.exp(2.1)


def test_fasta_over_scan_blocks(spark, tmp_path):
    """Records over many scan blocks: headers and offsets are carried on, whatever the blocks' bounds are."""
    from tidemark import sources

    rng = np.random.default_rng(3)
    records = [(f"r{k}", k % 3 + 1, "".join(rng.choice(list("ACGT"), n))) for k, n in enumerate((5000, 1, 0, 37, 900, 60, 61))]
    text = "".join(f">{name} {n}\n" + "".join(seq[i : i + 60] + "\n" for i in range(0, len(seq), 60)) for name, n, seq in records)
    (tmp_path / "a.fa").write_text("ACGT\n" + text)
    (tmp_path / "b.fa").write_text(">other\nacgtx\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for size in ("700", "100000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            got = sorted((r["tag_id"], r["n"], r["chunk"], r["origin"], r["seq"]) for r in sources.read_fasta_chunks(spark, str(tmp_path), 100, 7).collect())
            want = [(name, n, k, 100 * k, seq[100 * k : 100 * k + 107]) for name, n, seq in records for k in range(-(-len(seq) // 100))] + [("other", 1, 0, 0, "ACGTN")]
            assert got == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_z_histogram_matches_its_rows(spark):
    """The histogram of z against the rows it counts, and the elbow against the curve it is read from."""
    from tidemark.plans import q_models as q

    sf = "/root/testdata/sf0.001"
    rows = q._scored(spark, sf).select("z", "post").toPandas()
    at = np.clip(np.floor((rows["z"] + 10) * 10), 0, 200).astype(int)
    got = {r["bin"]: r for r in q.mod4(spark, sf).collect()}
    assert len(got) == 201
    for k in range(201):
        own = rows["post"][at == k]
        assert abs(got[k]["share"] - len(own) / len(rows)) < 1e-6 and abs(got[k]["enriched"] - own.sum() / len(rows)) < 1e-6 and abs(got[k]["background"] - (len(own) - own.sum()) / len(rows)) < 2e-6
    scores = np.round(np.array([r["score"] for r in q.v.regions(spark, sf).select("score").collect()]), 1)
    x = np.unique(scores)
    y = np.log([(scores >= v).sum() for v in x])
    cut = {r["kind"]: r["cutoff"] for r in q.win3(spark, sf).collect()}
    assert abs(cut["plain"] - m.elbow(x, y, 3.0)) < 1e-9 and abs(cut["log"] - m.elbow(x, y, None, size=1000, log_x=True)) < 1e-9 and 2 <= cut["z"] <= 5


def test_beta_matches_bisection(spark):
    """The query's beta of each motif against a plain bisection on the same counts."""
    from tidemark.plans import q_models as q

    sf = "/root/testdata/sf0.001"
    sums = q.v.sites(spark, sf).groupBy("region_id", "wm").agg(F.sum("post").alias("n"))
    counts = sums.join(q.v.regions(spark, sf).select("region_id", (F.col("end") - F.col("start")).alias("len")), "region_id").toPandas()
    for r in q.mod10(spark, sf).collect():
        own = counts[counts["wm"] == r["wm"]]
        n, size = own["n"].to_numpy(), own["len"].to_numpy("f8")
        slope = lambda b: (size / (n + b * size)).sum() - len(n) * size.sum() / (n.sum() + b * size.sum())  # noqa: B023, E731
        lo, hi = 1e-12, 1000.0
        for _ in range(200):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if slope(mid) > 0 else (lo, mid)
        assert abs(r["beta"] - hi) < 1e-5 + 1e-6 * hi
