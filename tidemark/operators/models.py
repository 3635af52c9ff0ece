"""Iterative fits as Spark jobs: each step is one aggregation, and the driver holds only the parameters."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import chunks
from .intervals import nearest

#: Distinct rows of a mixture fit up to which its steps sum on the driver.
HISTOGRAM = 50_000


def log_ratios(windows: DataFrame, fg: Column, bg: Column, least: float = 2.0) -> DataFrame:
    """``x`` (log enrichment against the totals) and ``s`` (its sampling variance) of windows with enough counts.

    Totals and the number of windows cover all windows; then those with fewer than ``least`` counts on a side leave. Half a count is
    added on each side.
    """
    t = windows.agg(F.sum(fg).alias("tf"), F.sum(bg).alias("tb"), F.count("*").alias("n"))
    both = windows.withColumn("f", fg).withColumn("b", bg).filter((F.col("f") >= least) & (F.col("b") >= least)).join(F.broadcast(t))
    x = F.log((F.col("f") + 0.5) / (F.col("b") + 0.5)) + F.log((F.col("tb") + 0.5 * F.col("n")) / (F.col("tf") + 0.5 * F.col("n")))
    s = (1 / F.col("tf") + 1 / F.col("tb")) / ((F.col("f") + F.col("b") + 0.5) / (F.col("tf") + F.col("tb") + 0.5 * F.col("n")))
    return both.withColumn("x", x).withColumn("s", s).drop("tf", "tb", "n", "f", "b")


def replicate_ratios(windows: DataFrame, fg: list[str], bg: list[str], least: float = 2.0) -> DataFrame:
    """``x`` and ``s`` by replicate: means of log counts with a pseudo-count each (half a replicate's mean), variances added.

    A window stays if any replicate of a side has ``least`` counts. The sampling variance of a mean of m logs is the sum
    of 1/(count + pseudo) over m squared.
    """
    t = windows.agg(*[(F.sum(c) / (2 * F.count("*"))).alias(f"_p_{c}") for c in (*fg, *bg)])
    any_ = lambda side: F.greatest(*side) >= least if len(side) > 1 else F.col(side[0]) >= least
    joined = windows.filter(any_(fg) & any_(bg)).join(F.broadcast(t))
    full = lambda c: F.col(c) + F.col(f"_p_{c}")
    mean = lambda side: sum(F.log(full(c)) for c in side) / len(side)
    noise = lambda side: sum(1 / full(c) for c in side) / len(side) ** 2
    return joined.withColumn("x", mean(fg) - mean(bg)).withColumn("s", noise(fg) + noise(bg)).drop(*[f"_p_{c}" for c in (*fg, *bg)])


def fit_mixture(df: DataFrame, width: float = 0.01, most_steps: int = 100, histogram: int = HISTOGRAM) -> dict[str, float]:
    """Mixture of a uniform share ``rho`` and a normal ``mu, q + s`` of the rows ``x, s``; rows with a null in either take no part.

    Equal rows are counted first. Both follow from two counts of a window, so there are few pairs, however many windows; up to ``histogram``
    of them the steps sum over that list on the driver, beyond it each step is one job over the cached list. Both sum the same terms. The outer search halves the interval of q by the sign of the likelihood's derivative
    until its width is ``width`` of its middle; inside, from the mean on, expectation-maximisation steps of rho and mu, each one pass
    that sums four terms, run until the sum of their relative changes is within ``width``.
    """
    rows = df.filter("x is not null and s is not null").groupBy("x", "s").agg(F.count("*").alias("n")).cache()
    try:
        base = rows.agg(F.sum("n"), F.min("x"), F.max("x"), F.sum(F.col("n") * F.col("x")), F.sum(F.col("n") * F.col("x") ** 2), F.count("*")).first()
        count, low, high, sx, sxx, pairs = (float(v or 0) for v in base)
        if not count or high <= low:
            return {"rho": 0.0, "mu": sx / count if count else 0.0, "q": 0.001, "range": 1.0}
        span, mean, rho = high - low, sx / count, 0.005
        mu, lo, hi = mean, 0.001, max(0.001, 1.25 * (sxx / count - mean * mean))
        q = (lo + hi) / 2

        def step(q: float, mu: float, rho: float) -> list[float]:
            v, off = F.col("s") + q, (F.col("x") - mu) ** 2
            normal = (1 - rho) * F.exp(-off / (2 * v)) / F.sqrt(2 * math.pi * v)
            same = F.col("n") * normal / (rho / span + normal) if rho else F.col("n")
            got = rows.agg(F.sum(F.col("n") - same), F.sum(same * F.col("x") / v), F.sum(same / v), F.sum(same * (off / v**2 - 1 / v))).first()
            return [float(g or 0) for g in got]

        if pairs <= histogram:
            x, s, n = (c.to_numpy("f8") for _, c in rows.select("x", "s", "n").orderBy("x", "s").toPandas().items())

            def step(q: float, mu: float, rho: float) -> list[float]:
                v, off = s + q, (x - mu) ** 2
                normal = (1 - rho) * np.exp(-off / (2 * v)) / np.sqrt(2 * math.pi * v)
                same = n * normal / (rho / span + normal) if rho else n
                return [float(t.sum()) for t in (n - same, same * x / v, same / v, same * (off / v**2 - 1 / v))]

        while 2 * (hi - lo) / (hi + lo) > width:
            q, mu, slope = (lo + hi) / 2, mean, 0.0
            if not 1e-6 < rho < 1:
                rho = 0.005
            for _ in range(most_steps):
                other, a, b, slope = step(q, mu, rho)
                new_mu, new_rho = (a / b if b else mu), other / count
                new_rho = new_rho if new_rho >= 1e-6 else 0.0
                change = abs(new_rho - rho) / (2 * (new_rho + rho)) if new_rho + rho else 0.0
                change += abs(new_mu - mu) / (2 * abs(new_mu + mu)) if new_mu + mu else 0.0
                mu, rho = new_mu, new_rho
                if change <= width:
                    break
            lo, hi = (lo, q) if slope < 0 else (q, hi)
        return {"rho": rho, "mu": mu, "q": q, "range": span}
    finally:
        rows.unpersist()


def z_scores(df: DataFrame, fit: dict[str, float]) -> DataFrame:
    """``z`` and ``post`` (of enrichment) by the fitted mixture; without a uniform share ``post`` is 0 everywhere, also where the normal vanishes."""
    v = F.col("s") + fit["q"]
    normal = (1 - fit["rho"]) * F.exp(-((F.col("x") - fit["mu"]) ** 2) / (2 * v)) / F.sqrt(2 * math.pi * v)
    other = fit["rho"] / fit["range"]
    return df.withColumn("z", (F.col("x") - fit["mu"]) / F.sqrt(v)).withColumn("post", F.lit(other) / (other + normal) if other else F.lit(0.0))


def peak_z(peaks: DataFrame, windows: DataFrame, fg: list[str], bg: list[str], fragment: float, width: float, sigma: float, mu: float) -> DataFrame:
    """``z`` of peaks (``peak_id, chrom, start, end, height, sd, back``) against the background of the window nearest to their middle.

    The foreground count is that of the fitted peak and of its uniform background in a window, for all replicates; expected counts
    by the pooled frequency give the sampling variance, ``sigma`` and ``mu`` of the noise fit the rest.
    """
    t = windows.agg(F.sum(sum(map(F.col, fg))).alias("tf"), F.sum(sum(map(F.col, bg))).alias("tb"), F.count("*").alias("n"))
    places = peaks.withColumn("middle", F.expr("(start + end) div 2"))
    near = nearest(places, windows.select("chrom", "middle", F.col("middle").cast("string").alias("_win")), "peak_id", "_win")
    counts = windows.select("chrom", F.col("middle").alias("_at"), sum(map(F.col, bg)).alias("_b"))
    met = places.join(near.select("peak_id", F.col("near_id").cast("long").alias("_at")), "peak_id").join(counts, ["chrom", "_at"]).join(F.broadcast(t))
    f = (F.col("height") * math.sqrt(2 * math.pi) * F.col("sd") / fragment + F.col("back") * width / fragment) * len(fg)
    pooled = (f + F.col("_b") + 0.5) / (F.col("tf") + F.col("tb") + 0.5 * F.col("n"))
    spread = F.sqrt(2 * sigma**2 + 1 / (F.col("tf") * pooled) + 1 / (F.col("tb") * pooled))
    x = F.log((f + 0.5) / (F.col("_b") + 0.5)) + F.log((F.col("tb") + 0.5 * F.col("n")) / (F.col("tf") + 0.5 * F.col("n")))
    return met.withColumn("z", (x - mu) / spread).drop("middle", "_at", "_b", "tf", "tb", "n")


#: Values of the tables of components and positions that are worked on at once: they stay in a core's cache.
CELLS = 65_536
#: Starts of a fit, and its steps at most.
STARTS, STEPS = 5, 60


def fit_profile(profile: pd.DataFrame, fragment: float, most_total: float = 50_000, seed: int = 3) -> pd.DataFrame:
    """Normal components and a uniform background of one coverage profile (``bp, cov``): ``rho, mu, sigma, height, rmsd, uniform``.

    As many components as fragments fit four times into the profile, 2 to 30; several starts, the likeliest fit wins;
    overlapping components become one. The curve of the mixture stays that of all components: its value at a peak's middle without the uniform part is the
    height, in units of the profile, ``uniform`` that part's; ``rmsd`` is the mean deviation of the profile, smoothed over five positions, from the curve within a sigma of
    the middle, both scaled by the curve's greatest value.
    """
    found = fit_many([profile["bp"].to_numpy("f8")], [profile["cov"].to_numpy("f8")], fragment, most_total, seed)[0]
    return pd.DataFrame(found, columns=["rho", "mu", "sigma", "height", "rmsd", "uniform"])


def fit_many(places: list[np.ndarray], covs: list[np.ndarray], fragment: float, most_total: float = 50_000, seed: int = 3) -> list[list[tuple]]:
    """The components of each profile as in :func:`fit_profile`; profiles of alike lengths take their steps together."""
    out: list[list[tuple]] = [[] for _ in places]
    groups: dict[int, list[int]] = {}
    weights = [c.clip(min=0) for c in covs]
    for i, (x, w) in enumerate(zip(places, weights, strict=True)):
        if w.sum() > 0:
            groups.setdefault(int(min(max(x.max() // (4 * fragment), 2), 30)), []).append(i)
    for k, group in groups.items():
        group.sort(key=lambda i: len(places[i]))
        while group:
            n = max(1, CELLS // (STARTS * k * len(places[group[-1]])))
            some, group = group[-n:], group[:-n]
            wholes = [float(weights[i].sum()) for i in some]
            scaled = [weights[i] * min(1.0, most_total / t) for i, t in zip(some, wholes, strict=True)]
            fits = _mixtures([places[i] for i in some], scaled, k, fragment, seed)
            for i, w, whole, (mu, sigma, rho) in zip(some, scaled, wholes, fits, strict=True):
                out[i] = peaks_of(places[i], w / w.sum(), whole, mu, sigma, rho, _joined(mu, sigma, rho))
    return out


def _mixtures(places: list[np.ndarray], weights: list[np.ndarray], k: int, fragment: float, seed: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``mu, sigma, rho`` of the likeliest of each profile's fits with ``k`` components. Profiles and starts are rows of one table, short ones with positions without weight behind; rows leave as they settle."""
    wide = max(map(len, places))
    x, w = np.empty((len(places), wide)), np.zeros((len(places), wide))
    for i, (p, c) in enumerate(zip(places, weights, strict=True)):
        x[i, : len(p)], x[i, len(p) :], w[i, : len(c)] = p, p[-1], c
    row = np.repeat(np.arange(len(places)), STARTS)
    x, w, total_w = x[row], w[row], w.sum(1)[row]
    low, high = (np.array([f(p) for p in places])[row] for f in (np.min, np.max))
    lo_s, hi_s = max(1.0, 0.414 * fragment - 11.5), 0.414 * fragment + 45.5
    draws = np.tile(np.random.default_rng(seed).random((STARTS, k)), (len(places), 1))
    mu, sigma, rho = low[:, None] + (high - low)[:, None] * draws, np.full((len(row), k), (lo_s + hi_s) / 2), np.full((len(row), k + 1), 1 / (k + 1))
    before, likes, on = np.full(len(row), -np.inf), np.empty(len(row)), np.arange(len(row))
    for _ in range(STEPS):
        m, s, r = mu[on], sigma[on], rho[on]
        off = x[:, None] - m[:, :, None]
        dens = off * off
        dens *= (-1 / (2 * s**2))[:, :, None]
        np.exp(dens, out=dens)
        dens *= (r[:, :k] / (np.sqrt(2 * np.pi) * s))[:, :, None]
        total = dens.sum(1)
        total += (r[:, k] / high[on])[:, None]
        np.maximum(total, 1e-300, out=total)
        dens *= (w / total)[:, None]
        mass = np.maximum(dens.sum(2), 1e-12)
        dens *= off
        first = dens.sum(2) / mass
        dens *= off
        square = dens.sum(2) / mass
        mu[on] = np.clip(m + first, low[on, None], high[on, None])
        moved = mu[on] - m
        sigma[on] = np.clip(np.sqrt(np.maximum(square - 2 * moved * first + moved**2, 0)), lo_s, hi_s)
        rho[on] = np.concatenate((mass, np.maximum(0.0, total_w[on] - mass.sum(1))[:, None]), 1) / total_w[on, None]
        np.log(total, out=total)
        total *= w
        like = likes[on] = total.sum(1)
        stays = like - before[on] >= 1e-6 * np.abs(like)
        before[on] = like
        if not stays.all():
            on, x, w = on[stays], x[stays], w[stays]
            if not len(on):
                break
    best = likes.reshape(-1, STARTS).argmax(1) + np.arange(len(places)) * STARTS
    return [(mu[i], sigma[i], rho[i]) for i in best]


def _joined(mu: np.ndarray, sigma: np.ndarray, rho: np.ndarray) -> list[tuple[float, float, float]]:
    """``share, mu, sigma`` of the components, overlapping ones as one."""
    joined: list[list[float]] = []
    for m, s, p in sorted((m, s, p) for m, s, p in zip(mu, sigma, rho[:-1], strict=True) if p > 1e-3):
        if joined and m - s <= joined[-1][0] + joined[-1][1]:
            a = joined[-1]
            t = a[2] + p
            joined[-1] = [(a[0] * a[2] + m * p) / t, (a[1] * a[2] + s * p) / t, t]
        else:
            joined.append([m, s, p])
    return [(p, m, s) for m, s, p in joined]


def peaks_of(x: np.ndarray, shares: np.ndarray, whole: float, mu: np.ndarray, sigma: np.ndarray, rho: np.ndarray, joined: list[tuple[float, float, float]]) -> list[tuple]:
    """Heights and deviations of joined components ``share, mu, sigma`` of a fitted curve (see ``fit_profile``)."""
    flat = rho[-1] / float(x.max())
    curve = (rho[:-1] * np.exp(-((x[:, None] - mu) ** 2) / (2 * sigma**2)) / (np.sqrt(2 * np.pi) * sigma)).sum(1) + flat
    top, smooth = curve.max(), np.convolve(shares, np.ones(5) / 5, "same")
    out = []
    for p, m, s in joined:
        at = slice(max(int(m - s), 0), min(int(m + s), len(x) - 1))
        off = np.abs(smooth[at] - curve[at]) / top
        out.append((p, m, s, (curve[min(max(int(m) - 1, 0), len(x) - 1)] - flat) * whole, float(off.mean()) if len(off) else 10.0, flat * whole))
    return out


def fit_profiles(profiles: DataFrame, fragment: float) -> DataFrame:
    """``region_id, rho, mu, sigma, height, rmsd, uniform`` of every region's profile (``region_id, cov``: its positions' coverage in order)."""
    names = ["region_id", "rho", "mu", "sigma", "height", "rmsd", "uniform"]

    def each(frames):
        for frame in frames:
            covs = [np.asarray(c, "f8") for c in frame["cov"]]
            found = fit_many([np.arange(1.0, len(c) + 1) for c in covs], covs, fragment)
            rows = [(region, *peak) for region, peaks in zip(frame["region_id"], found, strict=True) for peak in peaks]
            yield pd.DataFrame(rows, columns=names).astype({c: object if c == "region_id" else "f8" for c in names})

    # Profiles are small next to the work on them, so they are dealt evenly whatever the join before left.
    tasks = 16 * profiles.sparkSession.sparkContext.defaultParallelism
    return profiles.select("region_id", "cov").repartition(tasks, "region_id").mapInPandas(each, "region_id string, rho double, mu double, sigma double, height double, rmsd double, uniform double")


def fit_beta(counts: DataFrame, passes: int = 10, points: int = 15) -> DataFrame:
    """``wm, beta``: where the derivative of the enrichment likelihood, sum of len/(n + beta len) - M L/(N + beta L), is 0.

    ``counts`` has ``wm, n, len``: sites and length of each region. Every pass evaluates ``points`` values between each
    motif's bounds in one aggregation, so the interval shrinks sixteenfold; nothing of a motif is gathered in one task.
    """
    spark = counts.sparkSession
    counts = counts.cache()
    totals = {r["wm"]: r for r in counts.groupBy("wm").agg(F.sum("n").alias("n"), F.sum("len").alias("len"), F.count("*").alias("m")).collect()}
    bounds = {wm: (0.0, 1e3) for wm in totals}
    for _ in range(passes):
        grid = {wm: [lo + (hi - lo) * (k + 1) / (points + 1) for k in range(points)] for wm, (lo, hi) in bounds.items()}
        table = F.broadcast(spark.createDataFrame([(wm, g) for wm, g in grid.items()], "wm long, g array<double>"))
        terms = [F.sum(F.col("len") / (F.col("n") + F.col("g")[k] * F.col("len"))).alias(f"t{k}") for k in range(points)]
        for r in counts.join(table, "wm").groupBy("wm").agg(*terms).collect():
            wm, t = r["wm"], totals[r["wm"]]
            slope = [float(r[f"t{k}"]) - t["m"] * t["len"] / (t["n"] + b * t["len"]) for k, b in enumerate(grid[wm])]
            lo, hi = bounds[wm]
            up = [b for b, d in zip(grid[wm], slope, strict=True) if d > 0]
            lo = max([lo, *up])
            hi = min([hi, *[b for b in grid[wm] if b > lo]])
            bounds[wm] = (lo, hi)
    counts.unpersist()
    return spark.createDataFrame([(wm, (lo + hi) / 2) for wm, (lo, hi) in sorted(bounds.items())], "wm long, beta double")


def enrichment(regions: DataFrame, sums: DataFrame, beta: float, share: int = 11) -> DataFrame:
    """One row ``mean, spread, total``: the enrichment of regions (``region_id, len``) by their posterior sums (``region_id, n``).

    A region's score is ln(n + beta len) - (ln(N + beta L) - ln M). The foreground is one of ``share`` regions; those of it without a
    site have n = 0 and the mean length. ``mean`` and ``spread`` are exponentiated.
    """
    t = regions.agg(F.sum("len").alias("tl"), F.avg("len").alias("al"), F.count("*").alias("m"))
    c = regions.join(sums, "region_id")
    e = F.log(F.col("n") + beta * F.col("len"))
    k = c.agg(F.count("*").alias("k"), F.coalesce(F.sum("n"), F.lit(0.0)).alias("tn"), F.coalesce(F.sum(e), F.lit(0.0)).alias("s1"), F.coalesce(F.sum(e * e), F.lit(0.0)).alias("s2"))
    one = t.join(F.broadcast(k)).withColumn("d", F.log(F.col("tn") + beta * F.col("tl")) - F.log("m")).withColumn("e0", F.log(beta * F.col("al")))
    one = one.withColumn("rest", F.greatest(F.expr(f"m div {share}") - F.col("k"), F.lit(0))).withColumn("all", F.col("k") + F.col("rest"))
    mean = (F.col("s1") + F.col("rest") * F.col("e0")) / F.col("all")
    square = (F.col("s2") + F.col("rest") * F.col("e0") * F.col("e0")) / F.col("all")
    spread = F.sqrt(F.greatest(square - mean * mean, F.lit(0.0)))
    return one.select(F.exp(mean - F.col("d")).alias("mean"), F.exp(spread).alias("spread"), ((mean - F.col("d")) * F.col("all")).alias("total"))


def forward_selection(sums: DataFrame, regions: DataFrame, beta: float, least_gain: float, most: int) -> list[tuple[int, float]]:
    """Motifs in the order in which they are taken, each with the score of the set.

    ``sums`` has ``region_id, wm, n``, ``regions`` ``region_id, len, fg``. The score of a set is the log-likelihood ratio of its joint sites in the foreground:
    the sum over foreground regions of ln(n + beta len) - (ln(N + beta L) - ln M), with n the region's sites of all motifs
    of the set and N, L, M sums over all regions. A round joins the set's sums, once, to those of every candidate left: one job,
    whose result has a row a candidate.
    """
    total = regions.agg(F.sum("len").alias("tl"), F.count("*").alias("m"), F.count_if("fg").alias("mf"), F.sum(F.when(F.col("fg"), F.log(beta * F.col("len")))).alias("empty")).first()
    tl, m_all, m_fg, empty = float(total["tl"] or 0), total["m"], total["mf"], float(total["empty"] or 0)
    rows = sums.join(regions, "region_id").cache()
    chosen: list[tuple[int, float]] = []
    taken = F.lit(False)
    while len(chosen) < most:
        base = rows.filter(taken).groupBy("region_id").agg(F.sum("n").alias("base"))
        log = lambda n: F.when(F.col("fg"), F.log(n + beta * F.col("len"))).otherwise(0.0)
        with_base = rows.filter(~taken).join(base, "region_id", "left").withColumn("base", F.coalesce("base", F.lit(0.0)))
        gain = with_base.groupBy("wm").agg(F.sum(log(F.col("base") + F.col("n")) - log(F.col("base"))).alias("more"), F.sum("n").alias("n"))
        own = rows.filter(taken).groupBy("region_id").agg(F.sum("n").alias("n"), F.first("len").alias("len"), F.first("fg").alias("fg"))
        old = own.agg(F.coalesce(F.sum(log(F.col("n")) - log(F.lit(0.0))), F.lit(0.0)).alias("base"), F.coalesce(F.sum("n"), F.lit(0.0)).alias("nb"))
        ll = F.lit(empty) + F.col("base") + F.col("more") - m_fg * (F.log(F.col("nb") + F.col("n") + beta * tl) - math.log(max(m_all, 1)))
        best = gain.join(F.broadcast(old)).agg(F.max_by(F.struct("wm", ll.alias("ll")), F.struct(ll, -F.col("wm")))).first()[0]
        if best is None or chosen and best["ll"] - chosen[-1][1] < least_gain:
            break
        chosen.append((best["wm"], best["ll"]))
        taken = taken | (F.col("wm") == best["wm"])
    rows.unpersist()
    return chosen


def scan_matrices(sequences: DataFrame, matrices: dict[int, np.ndarray], cutoff: float, background: float = 0.25, size: int = 65_536) -> DataFrame:
    """``doc_id, wm, pos, strand, score``: places where the log-odds of a matrix (columns x ACGT) reaches the cutoff, on the better strand.

    N counts as the mean of a column. Places that can reach the cutoff are found for all matrices at once from sums of words of letters, to single precision; only those are summed letter by letter.
    Sequences go in chunks of ``size`` letters, each with as many of the next as the widest matrix reaches over its end, so a task never holds a long one; chunks are dealt evenly, however few files the sequences lie in,
    and several are scanned as one text. One pass with the library, whose size the caller bounds, as a broadcast constant.
    """
    names = list(matrices)
    wide = max((len(x) for x in matrices.values()), default=1)
    odds = np.zeros((len(names), 2, wide, 5))  # matrix, strand, column, letter (A, C, G, T, N)
    for k, matrix in enumerate(matrices.values()):
        one = np.log2(matrix / background)
        table = np.vstack([one.T, one.mean(1)]).T
        odds[k, 0, : len(table)], odds[k, 1, : len(table)] = table, table[::-1][:, [3, 2, 1, 0, 4]]
    widths = np.array([len(x) for x in matrices.values()], "i8")
    spark = sequences.sparkSession
    shared = spark.sparkContext.broadcast((names, odds, widths, letter_codes()))

    def scan(batches):
        names, odds, widths, code = shared.value
        blocks = []
        for k in range(0, len(names), LIBRARY):
            both = {(i, s): np.maximum(odds[i, s, : widths[i]], -1e30) for i in range(k, min(k + LIBRARY, len(names))) for s in (0, 1)}
            blocks.append((k, _word_tables(both, np.add, "f4")))
        for batch in batches:
            for begin, end in _together(batch["seq"].str.len().to_numpy()):
                some = batch[begin:end]
                text = "".join(some["seq"]).encode("latin-1", "replace")
                x = np.concatenate((code[np.frombuffer(text, "u1")], np.full(wide, 4)))
                lengths = some["seq"].str.len().to_numpy()
                ends = np.cumsum(lengths)
                for first, words in blocks:
                    at, k = _reaching(x[: len(text)], words, cutoff)
                    k += first
                    chunk = np.searchsorted(ends, at, "right")
                    off = at - ends[chunk] + lengths[chunk]
                    keep = (off < size) & (off + widths[k] <= lengths[chunk])
                    at, k, chunk, off = at[keep], k[keep], chunk[keep], off[keep]
                    plus, minus = (sum(odds[k, s, j, x[at + j]] for j in range(wide)) for s in (0, 1))
                    top = np.maximum(plus, minus)
                    on = np.flatnonzero(top >= cutoff)
                    if len(on):
                        chunk = chunk[on]
                        yield pd.DataFrame({
                            "doc_id": some["doc_id"].to_numpy()[chunk], "wm": np.array(names)[k[on]], "pos": some["origin"].to_numpy()[chunk] + off[on],
                            "strand": np.where(plus[on] >= minus[on], "+", "-").astype(object), "score": top[on],
                        })

    dealt = chunks(sequences, size, wide - 1).repartition(4 * spark.sparkContext.defaultParallelism, "doc_id", "origin")
    return dealt.mapInPandas(scan, "doc_id long, wm long, pos long, strand string, score double")


#: Matrices whose words' tables are summed at once, and letters of chunks that are scanned as one text.
LIBRARY, LETTERS = 256, 1 << 18


def _together(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Beginnings and ends of runs of texts with up to ``LETTERS`` letters (or one text)."""
    begin = total = 0
    for k, n in enumerate(lengths):
        if k > begin and total + n > LETTERS:
            yield begin, k
            begin, total = k, 0
        total += n
    if len(lengths):
        yield begin, len(lengths)


#: Letters of a word whose columns are worked out beforehand.
WORD = 4
#: Positions of a sequence whose words are summed at once.
WORDS = 256


def _word_tables(columns: dict, join: np.ufunc, kind: str) -> tuple[list, list[np.ndarray]]:
    """Names, and for each word of ``WORD`` columns a table ``words x names`` of its columns (``columns x letters`` a name) joined; columns that a name lacks change nothing."""
    wide = max((len(c) for c in columns.values()), default=0)
    out = []
    for begin in range(0, wide, WORD):
        table = np.full((1, len(columns)), join.identity, "f8")
        for j in range(begin, min(begin + WORD, wide)):
            letters = np.array([c[j] if j < len(c) else np.full(5, join.identity) for c in columns.values()]).T
            table = join(table[:, None], letters[None]).reshape(-1, len(columns))
        out.append(np.ascontiguousarray(table, kind))
    return list(columns), out


def _words(x: np.ndarray, tables: list[np.ndarray]) -> list[np.ndarray]:
    """For each table the numbers of the words that begin at each position; behind the end all letters are N."""
    n = len(x)
    x = np.concatenate((x, np.full(WORD * (len(tables) + 1), 4, x.dtype)))
    out = []
    for k, table in enumerate(tables):
        number, size = np.zeros(n, "i8"), 1
        for j in range(WORD):
            if size < len(table):
                number = number * 5 + x[k * WORD + j : k * WORD + j + n]
                size *= 5
        out.append(number)
    return out


def _may_reach(x: np.ndarray, words: tuple[list, list[np.ndarray]], cutoff: float) -> list[np.ndarray]:
    """For each matrix (two names, one a strand) the positions at which a strand's sum comes within single precision of the cutoff."""
    at, k = _reaching(x, words, cutoff)
    return [np.sort(at[k == i]) for i in range(len(words[0]) // 2)]


def _reaching(x: np.ndarray, words: tuple[list, list[np.ndarray]], cutoff: float) -> tuple[np.ndarray, np.ndarray]:
    """The same as positions and places of matrices, each pair once; rows of tables are summed in place, which takes a quarter of the time of new arrays."""
    names, tables = words
    numbers = _words(x, tables)
    slack = 1e-3 + 1e-6 * sum(float(np.abs(t[np.abs(t) < 1e29]).max(initial=0)) for t in tables)
    found = []
    first, next_ = (np.empty((WORDS, len(names)), tables[0].dtype) for _ in range(2)) if tables else (None, None)
    for begin in range(0, len(x) if tables else 0, WORDS):
        n = min(WORDS, len(x) - begin)
        total, more = first[:n], next_[:n]
        np.take(tables[0], numbers[0][begin : begin + n], 0, total, "clip")
        for table, number in zip(tables[1:], numbers[1:], strict=True):
            np.take(table, number[begin : begin + n], 0, more, "clip")
            total += more
        at = np.flatnonzero(total >= cutoff - slack)
        if len(at):
            found.append((at // len(names) + begin) * len(names) + at % len(names))
    every = np.concatenate(found) if found else np.zeros(0, "i8")
    at, k = np.divmod(every, max(1, len(names)))
    every = np.unique(at * max(1, len(names)) + k // 2)
    return np.divmod(every, max(1, len(names)))


def letter_codes() -> np.ndarray:
    code = np.full(256, 4, "i8")
    for k, c in enumerate(b"ACGT"):
        code[c] = k
    return code


def log_likelihoods(sequences: DataFrame, matrices: dict[int, np.ndarray], priors: list[float], background: float = 0.25) -> DataFrame:
    """``doc_id, wm, prior, gain``: log-likelihood of each whole sequence under motif or background, over background alone.

    Forward recursion over positions: a sequence's prefix ends in a background letter or in a whole motif, on either strand with half the prior each. What all motifs bring at a position
    comes from products of words of letters, and sequences of alike lengths move on together with all pairs of a motif and a prior. Sequences are dealt evenly, however few files they lie in. Motifs have equal widths; a shorter sequence gains nothing.
    """
    spark = sequences.sparkSession
    shared = spark.sparkContext.broadcast((matrices, priors, letter_codes()))

    def run(batches):
        mats, grid, code = shared.value
        names = list(mats)
        odds = [np.hstack([mats[k] / background, np.ones((len(mats[k]), 1))]) for k in names]
        width = len(odds[0]) if odds else 1
        blocks = []
        for k in range(0, len(names), MOTIFS):
            some = odds[k : k + MOTIFS]
            both = {(s, i): y for s, side in enumerate((some, [x[::-1][:, [3, 2, 1, 0, 4]] for x in some])) for i, y in enumerate(side)}
            blocks.append((k, k + len(some), _word_tables(both, np.multiply, "f8")[1]))
        for batch in batches:
            xs = [code[np.frombuffer((seq or "").encode("latin-1", "replace"), "u1")] for seq in batch["seq"]]
            gain = np.zeros((len(xs), len(grid), len(names)))
            order = sorted((i for i, x in enumerate(xs) if len(x) >= width), key=lambda i: -len(xs[i]))
            for a, z, tables in blocks:
                n = max(1, ABREAST // (z - a))
                for at in range(0, len(order), n):
                    mine = order[at : at + n]
                    gain[mine, :, a:z] = _forward([xs[i] for i in mine], tables, width, np.array(grid, "f8"))
            rows = len(names) * len(grid)
            yield pd.DataFrame({
                "doc_id": np.repeat(batch["doc_id"].to_numpy(), rows), "wm": np.tile(np.repeat(np.array(names, "i8"), len(grid)), len(xs)),
                "prior": np.tile(np.array(grid, "f8"), len(names) * len(xs)), "gain": gain.transpose(0, 2, 1).ravel(),
            })

    dealt = sequences.select("doc_id", "seq").repartition(8 * spark.sparkContext.defaultParallelism, "doc_id")
    return dealt.mapInPandas(run, "doc_id long, wm long, prior double, gain double")


#: Motifs whose words' tables are multiplied at once, and motifs times sequences that move on together: their values stay in a core's cache.
MOTIFS, ABREAST = 128, 800


def _forward(xs: list[np.ndarray], tables: list[np.ndarray], width: int, priors: np.ndarray) -> np.ndarray:
    """The log of the last value of each sequence (the longest first, none below ``width``), prior and motif; ``tables``: words x motifs, once a strand.

    Values are divided by ``1 - p`` to the power of their position, so a step only adds what a motif ending there brings; those of ``width`` steps follow from values before them.
    """
    m, lengths = tables[0].shape[1] // 2, np.array([len(x) for x in xs])
    steps = lengths - width + 1
    numbers = np.zeros((len(tables), lengths[0], len(xs)), "u2")
    for d, x in enumerate(xs):
        for k, number in enumerate(_words(x, tables)):
            numbers[k, : len(x), d] = number
    p = priors[:, None]
    share = p / 2 * (1 - p) ** -float(width)
    scale, out = np.zeros((len(xs), len(priors), m)), np.empty((len(xs), len(priors), m))
    now = np.ones((width, len(xs), len(priors), m))  # before a whole motif fits, every value is 1
    first, next_ = (np.empty((width * len(xs), 2 * m)) for _ in range(2))
    for begin in range(0, int(steps[0]), width):
        on, k = int((steps > begin).sum()), min(width, int(steps[0]) - begin)
        one, more = first[: k * on], next_[: k * on]
        np.take(tables[0], numbers[0, begin : begin + k, :on].ravel(), 0, one, "clip")
        for table, number in zip(tables[1:], numbers[1:], strict=True):
            np.take(table, number[begin : begin + k, :on].ravel(), 0, more, "clip")
            one *= more
        place = one[:, :m] + one[:, m:]
        # The motif that begins behind i letters ends behind i + width of them; the values behind begin ... begin + width - 1 letters are in now.
        new = now[:k, :on] * place.reshape(k, on, 1, m)
        new *= share
        new[0] += now[-1, :on]
        for i in range(1, k):
            new[i] += new[i - 1]
        for d in np.flatnonzero(steps[:on] <= begin + k):
            out[d] = np.log(new[steps[d] - 1 - begin, d]) + scale[d] + lengths[d] * np.log1p(-p)
        factor = new[-1]
        scale[:on] += np.log(factor)
        now = new / factor
    return out


def elbow(x: np.ndarray, y: np.ndarray, default: float | None = 3.0, drop: float = 2.0, away: float = -0.5, size: int = 100, log_x: bool = False, clamp: tuple[float, float] | None = None) -> float:
    """Cutoff where a falling curve leaves its steepest line.

    The curve is sampled at ``size`` places (of log x, if ``log_x``), each with its nearest point. From the first place more than ``drop`` below
    the maximum on, least-squares lines through the next 2 ... a fifth of the places are fitted; the steepest one counts. Beyond
    its end the first place ``away`` below the line is the cutoff. Without one it is ``default``, or if that is None the mean plus
    three deviations of x. ``clamp`` bounds the result.
    """
    x, y = np.asarray(x, "f8"), np.asarray(y, "f8")
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    bound = (lambda c: float(min(max(c, clamp[0]), clamp[1]))) if clamp else float
    other = bound(default if default is not None else (x.mean() + 3 * x.std() if len(x) else 0.0))
    if len(x) < 10:
        return other
    at = np.log(np.maximum(x, 1e-12)) if log_x else x
    grid = np.linspace(at[0], at[-1], size)
    right = np.clip(np.searchsorted(at, grid), 1, len(at) - 1)
    nearest_ = np.where(grid - at[right - 1] <= at[right] - grid, right - 1, right)
    curve = y[nearest_]
    fallen = np.flatnonzero(curve.max() - curve > drop)
    if not len(fallen):
        return other
    first = int(fallen[0])
    lines = [(*np.polyfit(grid[first : first + n], curve[first : first + n], 1), n) for n in range(max(2, size // 50), size // 5) if first + n <= size]
    if not lines:
        return other
    slope, cut, n = min(lines, key=lambda line: line[0])
    beyond = np.flatnonzero(slope * grid[first + n :] + cut - curve[first + n :] <= away)
    if not len(beyond):
        return other
    found = grid[first + n + int(beyond[0])]
    return bound(np.exp(found) if log_x else found)
