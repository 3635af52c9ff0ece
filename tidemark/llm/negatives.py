"""Hard negatives of anchor vectors: clusters of anchors walk shared candidate lists, sorted by angular upper bounds, until certified."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, table
from .vectors import fit_codebook, usable

#: Anchors of one cluster that travel together, packs of them in one task, and components of the candidates in one task.
PACK_ROWS, PACKS_AT_ONCE, BLOCK_VALUES = 512, 8, 1 << 19
#: Anchors a cluster has on average, and the most clusters.
CLUSTER_ROWS, MOST_CLUSTERS = 64, 64
#: Candidates that are scored at first in one step of a walk, and at most.
STEP, MOST_STEP = 128, 2048
_NONE, _ALL = -(2**63), 2**63 - 1


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length 1 (zero rows stay), and the lengths."""
    norms = np.linalg.norm(x, axis=1)
    return x / np.where(norms > 0, norms, 1)[:, None], norms


def upper_bounds(rows: np.ndarray, norms: np.ndarray, centre: np.ndarray | None, radius: float) -> np.ndarray:
    """For unit ``rows`` and their lengths: no vector of length 1 within the angle ``radius`` of ``centre`` has a greater inner product with them."""
    if centre is None:
        return norms
    angle = np.arccos(np.clip(rows @ centre, -1, 1))
    return norms * np.cos(np.maximum(0, angle - radius - 1e-6))


class Best:
    """The k best scores within a band, ties to the smaller id; scores below ``low`` no longer count."""

    def __init__(self, low: int, high: int, k: int):
        self.low, self.high, self.k = low, high, k
        self.scores, self.ids = np.zeros(0, "i8"), np.zeros(0, "i8")

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        some = (scores >= self.low) & (scores <= self.high)
        if some.any():
            scores, ids = np.concatenate([self.scores, scores[some]]), np.concatenate([self.ids, ids[some]])
            first = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[first], ids[first]
            if len(first) == self.k:
                self.low = max(self.low, int(self.scores[-1]))


def walk(order: np.ndarray, bounds: np.ndarray, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, anchor: tuple[np.ndarray, np.ndarray, np.ndarray], bands: list[list[Best]], same: bool) -> int:
    """Every anchor (``vectors, ids, labels``) walks the rows in ``order`` of falling ``bounds``, until none that is left can enter a band of its; the number of scores.

    Rows count if their label is the anchor's (``same``) or another one; never the anchor's own id. A walk ends when the bound of the next row, times
    the anchor's length, is below what each of its bands still takes.
    """
    vectors, own, kinds = anchor
    lengths = np.linalg.norm(vectors.astype("f8"), axis=1)
    alive = np.arange(len(own))
    at, step, scored = 0, STEP, 0
    while at < len(order):
        reach = lengths[alive] * bounds[at]
        reach += np.abs(reach) * 1e-9 + 1
        alive = alive[[any(b.low <= r and b.low <= b.high for b in bands[i]) for i, r in zip(alive, reach, strict=True)]]
        if not len(alive):
            break
        here = order[at : at + step]
        scores = (vectors[alive] @ rows[here].T).astype("i8")
        scored += scores.size
        fits = ((labels[here][None] == kinds[alive][:, None]) == same) & (ids[here][None] != own[alive][:, None])
        for k, i in enumerate(alive):
            s, x = scores[k, fits[k]], ids[here][fits[k]]
            for band in bands[i]:
                band.add(s, x)
        at, step = at + step, min(2 * step, MOST_STEP)
    return scored


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, percent: tuple[int, int] = (80, 100), scale: int = 256, cluster_rows: int = CLUSTER_ROWS, most_clusters: int = MOST_CLUSTERS, sample_rows: int = 20_000, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: the hardest negatives of each anchor and positive.

    Components become ``floor(scale * x)`` with x as double; scores are integer inner products, higher first, ties to the smaller id. The positives of
    an anchor (row where ``anchor`` holds) are its best other rows of its label, at most ``positives``; for each of them the negatives are
    the best rows of other labels whose score is from ``percent[0]`` to ``percent[1]`` hundredths of the positive's.

    Anchors are clustered by direction (centres from at most ``sample_rows`` of them by hash; that decides costs, not results). In each block of
    candidates a cluster sorts them once by an angular upper bound that holds for all its members, and every member walks that list
    until no later row can matter. First each cluster walks the candidates nearest to its own centre; what is found there bounds the
    second walk, over all other cells but those whose best bound is too small for the whole cluster.

    Rows with a null id, label or vector, an empty vector, or null or non-finite components take no part; candidates of another length than
    the anchor's aren't its candidates. A row never is its own positive, nor is another row of its id; repeated rows are candidates
    each, while of anchors with one id the smallest (label, vector) is taken. Other columns are not carried; without anchors or partners there are no rows.
    """
    spark = rows.sparkSession
    x = F.transform(vec_col, lambda c: F.floor(F.lit(scale) * c.cast("double")))
    base = rows.filter(usable(rows, vec_col) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    base = base.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), x.alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    asked = base.filter("anchor")
    n_asked = asked.count()
    chosen = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(min(1.0, 0.9 * sample_rows / max(1, n_asked)) * (1 << 30))
    sample = asked.filter(chosen).select("v").limit(sample_rows).toPandas()["v"]
    dims = pd.Series([len(v) for v in sample]).mode()
    dims = int(dims.iloc[0]) if len(dims) else 0
    points = np.stack([v for v in sample if len(v) == dims]).astype("f8") if dims else np.zeros((0, 1))
    centres, _ = unit(fit_codebook(unit(points)[0], int(min(most_clusters, max(1, -(-n_asked // cluster_rows))))))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for size, part in frame.groupby(frame["v"].map(len)):
                v = np.stack(part["v"].to_list())
                u, norms = unit(v.astype("f8"))
                cosines = u @ centres.T if size == dims else np.ones((len(v), 1))
                cell = cosines.argmax(1)
                angle = np.where(norms > 0, np.arccos(np.clip(cosines[np.arange(len(v)), cell], -1, 1)), 0)
                cell = cell if size == dims else np.full(len(v), -size)
                yield part.assign(v=[r.tobytes() for r in v], cell=cell, angle=angle, dims=size)

    placed = table(base.mapInPandas(place, "id long, label string, v binary, anchor boolean, cell int, angle double, dims int"), "placed")
    # A zero vector has no direction: its scores are 0, whatever the bound.
    asked = table(placed.filter("anchor").groupBy("id").agg(F.min(F.struct("label", "v", "cell", "angle", "dims")).alias("r")).select("id", "r.*"), "anchors")
    clusters = {r["cell"]: r for r in asked.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect()}
    sizes = {r["cell"]: r for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("dims").alias("dims")).collect()}
    radius = {c: r["radius"] for c, r in clusters.items()}
    blocks = {c: -(-r["n"] // max(64, BLOCK_VALUES // r["dims"])) for c, r in sizes.items()}
    packs = [(c, p) for c in sorted(clusters) for p in range(-(-clusters[c]["n"] // PACK_ROWS))]
    bundle: dict[tuple[int, int], int] = {}
    for other in sorted({min(c, 0) for c, _ in packs}):  # packs of one length of vectors only share a task
        at = 1 + max(bundle.values(), default=-1)
        bundle |= {pack: at + k // PACKS_AT_ONCE for k, pack in enumerate(x for x in packs if min(x[0], 0) == other)}
    home = {(c, c) for c in clusters}
    away = _reachable(placed.filter(F.col("dims") == dims), centres, radius)

    def swept(bands: DataFrame, pairs: set[tuple[int, int]], same: bool, k: int) -> DataFrame:
        """``anchor, top, id, score``: of each anchor's bands (``high, low``) the k best rows of the pairs' (cluster, cell) blocks, block by block."""
        if not pairs:
            return spark.createDataFrame([], "anchor long, top long, id long, score long")
        by_cluster = spark.createDataFrame([(c, -(-clusters[c]["n"] // PACK_ROWS)) for c in clusters], "cell int, packs int")
        bundles = spark.createDataFrame([(c, p, b) for (c, p), b in bundle.items()], "cell int, pack int, bundle int")
        routes = sorted({(bundle[c, p], j) for c, j in pairs for cc, p in packs if cc == c})
        routes = spark.createDataFrame([(b, j, blocks[j]) for b, j in routes], "bundle int, to int, blocks int")
        own = asked.join(F.broadcast(by_cluster), "cell").withColumn("pack", F.pmod(F.xxhash64("id"), F.col("packs")).cast("int"))
        own = own.join(F.broadcast(bundles), ["cell", "pack"]).join(bands, "id")
        asks = own.join(F.broadcast(routes), "bundle").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        asks = asks.select("bundle", "to", "block", "id", "label", "v", "cell", "bands")
        to = routes.withColumnRenamed("to", "cell")
        there = placed.join(F.broadcast(to), "cell").withColumn("block", F.pmod(F.xxhash64("id", "v"), F.col("blocks")).cast("int"))
        there = there.select("bundle", F.col("cell").alias("to"), "block", "id", "label", "v")

        def search(key, members: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
            found = []
            if len(members) and len(block):
                q, m = (np.frombuffer(b"".join(f["v"]), "i8").reshape(len(f), -1) for f in (members, block))
                u, norms = unit(m.astype("f8"))
                peak = float(np.abs(m).max()) * float(np.abs(q).max()) * m.shape[1]
                if peak < 2**52:  # sums of whole numbers below 2^53 are exact in doubles
                    q, m = q.astype("f8"), m.astype("f8")
                kinds = pd.factorize(pd.concat([members["label"], block["label"]]))[0]
                ids, own_ids = block["id"].to_numpy(), members["id"].to_numpy()
                for cluster in sorted(set(members["cell"])):
                    if (cluster, key[1]) not in pairs:
                        continue
                    some = np.flatnonzero(members["cell"] == cluster)
                    bound = upper_bounds(u, norms, centres[cluster] if cluster >= 0 else None, radius[cluster])
                    order = np.argsort(-bound, kind="stable")
                    best = [[Best(b["low"], b["high"], k) for b in members["bands"].iloc[i]] for i in some]
                    walk(order, bound[order], m, ids, kinds[len(members) :], (q[some], own_ids[some], kinds[some]), best, same)
                    found += [(own_ids[i], b.high, x, s) for i, own_bests in zip(some, best, strict=True) for b in own_bests for x, s in zip(b.ids, b.scores, strict=True)]
            return pd.DataFrame(found, columns=["anchor", "top", "id", "score"])

        at = ["bundle", "to", "block"]
        return asks.groupBy(*at).cogroup(there.groupBy(*at)).applyInPandas(search, "anchor long, top long, id long, score long")

    def first(found: DataFrame, k: int) -> DataFrame:
        order = Window.partitionBy("anchor", "top").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    def searched(bands: DataFrame, same: bool, k: int) -> DataFrame:
        """The k best rows of each band (``id, high, low``), from both walks."""
        listed = lambda df: df.groupBy("id").agg(F.collect_list(F.struct("low", "high")).alias("bands"))
        near = table(first(swept(listed(bands), home, same, k), k), "near")
        full = near.filter(F.col("rank") == k).select(F.col("anchor").alias("id"), F.col("top").alias("high"), F.col("score").alias("least"))
        left = table(bands.join(full, ["id", "high"], "left").select("id", "high", F.greatest("low", "least").alias("low")), "bands")
        need = asked.join(left, "id").groupBy("cell").agg(F.min("low").alias("low"), F.min(_length("v")).alias("short"), F.max(_length("v")).alias("long")).collect()
        reach = lambda r, most: max(most * r["short"], most * r["long"]) + abs(most) * r["long"] * 1e-9 + 1
        pairs = {(r["cell"], j) for r in need for j, most in away.get(r["cell"], {}).items() if j != r["cell"] and reach(r, most) >= r["low"]}
        far = swept(listed(left), pairs, same, k)
        out = table(first(near.drop("rank").unionByName(far), k), "best")
        forget(near, left)
        return out

    every = asked.select("id", F.lit(_ALL).alias("high"), F.lit(_NONE).alias("low"))
    alike = searched(every, True, positives).select("anchor", F.col("id").alias("positive"), F.col("score").alias("top"))
    down = lambda x: ((x - F.pmod(x, F.lit(100))) / 100).cast("long")
    low, high = -down(F.lit(-percent[0]) * F.col("top")), down(F.lit(percent[1]) * F.col("top"))
    band = alike.select(F.col("anchor").alias("id"), high.alias("high"), low.alias("low")).filter("low <= high").distinct()
    other = searched(band, False, negatives)
    pairs = alike.withColumn("key", high).join(other.select("anchor", F.col("top").alias("key"), "rank", "id", "score"), ["anchor", "key"])
    return pairs.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("id").alias("negative_id"), F.col("top").alias("positive_score"), F.col("score").alias("negative_score"))


def _length(v: str) -> Column:
    """Length of a packed vector of 64-bit whole numbers."""

    @F.pandas_udf("double")
    def made(values: pd.Series) -> pd.Series:
        return pd.Series([float(np.linalg.norm(np.frombuffer(b, "i8").astype("f8"))) for b in values], dtype="f8")

    return made(v)


def _reachable(placed: DataFrame, centres: np.ndarray, radius: dict[int, float]) -> dict[int, dict[int, float]]:
    """By cluster and cell the greatest upper bound of the cell's rows for an anchor of length 1: clusters times cells numbers."""
    inner = [c for c in radius if c >= 0]

    def bound(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                u, norms = unit(np.frombuffer(b"".join(frame["v"]), "i8").reshape(len(frame), -1).astype("f8"))
                for c in inner:
                    best = pd.Series(upper_bounds(u, norms, centres[c], radius[c])).groupby(frame["cell"].to_numpy()).max()
                    yield pd.DataFrame({"cluster": c, "cell": best.index, "most": best.to_numpy()})

    made = placed.select("cell", "v").mapInPandas(bound, "cluster int, cell int, most double")
    out: dict[int, dict[int, float]] = reduce(lambda d, c: d | {c: {}}, inner, {})
    for r in made.groupBy("cluster", "cell").agg(F.max("most").alias("most")).collect():
        out[r["cluster"]][r["cell"]] = r["most"]
    return out
