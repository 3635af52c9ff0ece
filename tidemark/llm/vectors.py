"""Exact top-k search by columnar branch-and-bound, and near-duplicate vectors by an inverted multi-index."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, map_rows, table

#: Candidates and queries that one task holds in one step of the search.
BLOCK_ROWS, QUERY_ROWS = 8192, 512
#: Packs of queries that one task takes to a block.
PACKS_AT_ONCE = 8
#: The floor of a query that has fewer than k answers so far.
NO_FLOOR = -(2**63)
#: Blocks that a wave of the search takes up, as a multiple of those before it: what a wave finds bounds the next one.
WAVE = 16
#: Dimensions that are accumulated between two prunings.
DIM_BLOCK = 16
#: Vectors of one cell, and probes into it, that one task compares.
CELL_ROWS = 1024
#: Vectors whose links are measured against all rows to set the reach, steps of that measure, and links below which the visit is complete.
MEASURED, STEPS, LEAST_LINKS = 1000, 400, 50


def usable(df: DataFrame, vec: str) -> F.Column:
    """True for vectors without null or non-finite components (a null vector is not usable)."""
    x = F.col(vec)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return x.isNotNull() & (F.size(x) > 0) & ~F.coalesce(bad, F.lit(True))


def _matrix(column: pd.Series, dims: int) -> np.ndarray:
    return np.stack(column.to_list()) if len(column) else np.zeros((0, dims), "i8")


def search_block(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int, floors: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``query, row, score`` of the k best rows of this block for each query, as far as they reach its floor; ties go to the smaller id.

    Rows lie column by column. After each block of dimensions a row's score lies within its partial sum plus or minus
    the product of what is left of both norms; rows whose upper end is below the k-th best lower end, or below the ``floors`` (the k-th best
    scores of other blocks, NO_FLOOR if there are fewer), leave.
    """
    n, dims = rows.shape
    peak = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * dims
    kind = "f8" if peak < 2**52 else "i8"  # sums of whole numbers below 2^53 are exact in doubles
    order = np.argsort(-np.square(rows.astype("f8")).sum(axis=0), kind="stable")
    columns = np.ascontiguousarray(rows[:, order].T.astype(kind))
    asked = queries[:, order].astype(kind)
    cuts = [*range(0, dims, DIM_BLOCK), dims]
    squares = np.square(columns.astype("f8"))
    left = [np.sqrt(squares[c:].sum(axis=0)) for c in cuts[1:]]
    for i, q in enumerate(asked):
        alive = np.flatnonzero(row_ids != query_ids[i])
        partial = np.zeros(len(alive), kind)
        for step, cut in enumerate(cuts[1:]):
            part = columns[cuts[step] : cut]
            part = part if len(alive) == n else part[:, alive]
            partial = partial + q[cuts[step] : cut] @ part
            if cut < dims and len(alive) > 0:
                slack = np.sqrt(np.square(q[cut:].astype("f8")).sum()) * left[step][alive] * (1 + 1e-9) + 1
                worst = float(floors[i])
                if len(alive) > k:
                    worst = max(worst, np.partition(partial - slack, len(alive) - k)[len(alive) - k])
                stay = partial + slack >= worst
                alive, partial = alive[stay], partial[stay]
        scores = partial.astype("i8")
        stay = scores >= floors[i]
        alive, scores = alive[stay], scores[stay]
        for j in np.lexsort((row_ids[alive], -scores))[:k]:
            yield int(query_ids[i]), int(row_ids[alive[j]]), int(scores[j])


def deal(rows: DataFrame, asked: DataFrame, blocks: int, packs: int, first: int, last: int) -> tuple[DataFrame, DataFrame]:
    """Packs of queries and rows of the blocks ``first`` to ``last`` with the groups (block, dims, some) in which they meet: each pack and block in one of them."""
    groups = -(-packs // PACKS_AT_ONCE)
    asked = asked.withColumn("pack", F.pmod(F.xxhash64("id"), F.lit(packs)).cast("int"))
    # One list of structs keeps a query's id, floor and vector in one place.
    lists = F.collect_list(F.struct("id", "floor", "v"))
    packed = asked.groupBy("pack", "dims").agg(lists.alias("l")).select("pack", "dims", F.col("l.id").alias("ids"), F.col("l.floor").alias("floors"), F.flatten("l.v").alias("vs"))
    packed = packed.withColumn("some", F.pmod("pack", F.lit(groups))).withColumn("block", F.explode(F.sequence(F.lit(first), F.lit(last))))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).filter(F.col("block").between(first, last))
    return packed, rows.withColumn("some", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, id_col, score``: the k candidates with the highest integer inner product with each query.

    Components become ``floor(scale * x)`` with x as double. A candidate with the query's own id is not its answer; ties
    go to the smaller id. Vectors that are null or empty, hold null or non-finite components, or have a null id take no
    part, nor do candidates of another length than the query's; rows with one id twice are two candidates.

    Candidates are dealt by hash into blocks of about BLOCK_ROWS, the stated queries into packs of QUERY_ROWS, and every
    pack meets every block once, in a group of one block and at most PACKS_AT_ONCE packs, however many queries there are. The blocks go in waves, one block first, then
    WAVE times as many as before: a query's k-th best score so far is its floor in the next wave, below which no row can be among its answers. Each
    task returns at most k rows a query, the ranking cuts to k rows a query again before it shuffles, and k rows a query are what a wave writes.
    """

    def whole(df: DataFrame) -> DataFrame:
        x = F.transform(vec_col, lambda v: F.floor(F.lit(scale) * v.cast("double")))
        rows = df.filter(usable(df, vec_col) & F.col(id_col).isNotNull())
        return rows.select(F.col(id_col).cast("long").alias("id"), x.alias("v"), F.size(vec_col).alias("dims"))

    rows, asked = whole(candidates), whole(queries)
    blocks, packs = max(1, -(-candidates.count() // BLOCK_ROWS)), max(1, -(-asked.count() // QUERY_ROWS))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")

    def search(key, packs: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(block) and len(packs):
            m, ids = _matrix(block["v"], key[1]), block["id"].to_numpy()
            for q_ids, vs, floors in zip(packs["ids"], packs["vs"], packs["floors"], strict=True):
                found += search_block(np.asarray(vs).reshape(-1, key[1]), np.asarray(q_ids), m, ids, k, np.asarray(floors))
        return pd.DataFrame(found, columns=["query_id", "id", "score"])

    best, first = None, 0
    while first < blocks:
        upto = min(blocks, max(1, WAVE * first))
        if best is None:
            floored = asked.withColumn("floor", F.lit(NO_FLOOR))
        else:
            best = table(best.select("query_id", "id", "score", "rank"), "best")
            floor = best.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
            floored = asked.join(floor, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(NO_FLOOR)))
        packed, part = deal(rows, floored, blocks, packs, first, upto - 1)
        met = packed.groupBy("block", "dims", "some").cogroup(part.groupBy("block", "dims", "some"))
        found = met.applyInPandas(search, "query_id long, id long, score long")
        best = found if best is None else best.select("query_id", "id", "score").unionByName(found)
        best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        first = upto
    return best.select("query_id", "rank", F.col("id").alias(id_col), "score")


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by their largest component first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, initial=0)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def fit_codebook(points: np.ndarray, size: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Centres of a half space by Lloyd's iterations on a bounded sample."""
    rng = np.random.default_rng(seed)
    if len(points) == 0:
        return np.zeros((1, points.shape[1]))
    centres = points[rng.choice(len(points), min(size, len(points)), replace=False)]
    for _ in range(rounds):
        near = ((points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)).argmin(1)
        for j in range(len(centres)):
            own = points[near == j]
            if len(own):
                centres[j] = own.mean(0)
    return np.unique(centres, axis=0)


def walls(half: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each point, and its distance to the plane beyond which each other centre is nearer."""
    d = (half**2).sum(1)[:, None] - 2 * half @ centres.T + (centres**2).sum(1)
    near = d.argmin(1)
    apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2))
    gap = d - d[np.arange(len(d)), near][:, None]
    return near, gap / np.maximum(2 * apart[near], 1e-12)


def multi_sequence(first: np.ndarray, second: np.ndarray, reach: float) -> list[tuple[int, int]]:
    """Cells of the product grid in order of ``first[i]^2 + second[j]^2``, up to ``reach^2``."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = np.square(first[a]), np.square(second[b])
    heap, seen, out = [(x[0] + y[0], 0, 0)], {(0, 0)}, []
    while heap:
        cost, i, j = heapq.heappop(heap)
        if cost > reach * reach:
            break
        out.append((int(a[i]), int(b[j])))
        for u, v in ((i + 1, j), (i, j + 1)):
            if u < len(a) and v < len(b) and (u, v) not in seen:
                seen.add((u, v))
                heapq.heappush(heap, (x[u] + y[v], u, v))
    return out


def measured_reach(classes: DataFrame, total: int, books: tuple[np.ndarray, np.ndarray], dims: int, threshold: float, target_recall: float) -> float:
    """Distance to walls within which ``target_recall`` of the links of up to MEASURED vectors (by hash) lie, rounded up to a step; the full length of a link if they have too few.

    The vectors go to every task, which scores its rows against them and returns how many links need which distance, from the vector in the smaller cell to the other's own cell: STEPS
    numbers, however many links there are.
    """
    full = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    chosen = F.pmod(F.xxhash64("class", F.lit(3)), F.lit(1_000_000_000)) < int(min(1.0, 0.9 * MEASURED / max(1, total)) * 1_000_000_000)
    asked = classes.filter(chosen & (F.size("v") == dims)).select("class", "label", "v").limit(MEASURED).toPandas()
    if not len(asked):
        return full
    q = unit_rows(np.stack(asked["v"].to_list()))
    shared = classes.sparkSession.sparkContext.broadcast((q, asked["class"].to_numpy(), asked["label"].to_numpy(), books))

    def crossed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        first, second = shared.value[3]
        (a, wall_a), (b, wall_b) = walls(x[:, : dims // 2], first), walls(x[:, dims // 2 :], second)
        return a, b, a * len(second) + b, wall_a, wall_b

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q, names, labels, _ = shared.value
        qa, qb, q_own, q_wall_a, q_wall_b = crossed(q)
        found = np.zeros(STEPS + 1, "i8")
        for frame in frames:
            frame = frame[frame["v"].map(len) == dims]
            for at in range(0, len(frame), CELL_ROWS):
                part = frame.iloc[at : at + CELL_ROWS]
                x = unit_rows(np.stack(part["v"].to_list()))
                near = (x @ q.T >= threshold) & (part["label"].to_numpy()[:, None] == labels[None]) & (part["class"].to_numpy()[:, None] != names[None])
                i, j = np.nonzero(near)
                if len(i):
                    a, b, own, wall_a, wall_b = crossed(x)
                    from_x = np.hypot(wall_a[i, qa[j]], wall_b[i, qb[j]])
                    from_q = np.hypot(q_wall_a[j, a[i]], q_wall_b[j, b[i]])
                    need = np.where(own[i] < q_own[j], from_x, np.where(own[i] > q_own[j], from_q, 0))
                    found += np.bincount(np.minimum(np.ceil(need / full * STEPS).astype("i8"), STEPS), minlength=STEPS + 1)
        yield pd.DataFrame({"step": np.flatnonzero(found), "n": found[found > 0]})

    rows = classes.select("class", "label", "v").mapInPandas(count, "step int, n long").groupBy("step").agg(F.sum("n").alias("n")).collect()
    links = sum(r["n"] for r in rows)
    if links < LEAST_LINKS:
        return full
    upto = 0
    for r in sorted(rows, key=lambda r: r["step"]):
        upto += r["n"]
        if upto >= target_recall * links:
            return min(full, (r["step"] + 1) / STEPS * full)
    return full


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, sample_rows: int = 20_000, target_recall: float = 0.9995, rows_per_cell: int = 2000, most_centres: int = 64, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``id_col, n_links, component_id, kept`` for every row: links are pairs of one label with cosine of at least ``threshold``.

    Exact copies (equal label and components) become one class first and are never paired; n_links counts them all
    the same. Two codebooks, fitted on at most ``sample_rows`` vectors, cut the halves of the unit vectors into a
    product grid that holds every vector, about ``rows_per_cell`` a cell, of at most ``most_centres`` centres a half. A vector visits the
    cells in multi-sequence order of its distance to their walls until the target recall. How far that is gets measured (:func:`measured_reach`): all links
    of up to MEASURED vectors, found among all rows, tell which distances to walls links cross in these data, and the reach is that within which ``target_recall`` of them lie. With fewer than LEAST_LINKS such links, or at a target of 1, it
    is the length of a link at the threshold, within which the visit is complete whatever the directions.
    Every pair is met once, from the smaller cell, and verified in double precision. A task compares at most
    CELL_ROWS members with CELL_ROWS probes and returns counts and one link to a root instead of pairs.

    Vectors that are null, zero, empty or hold null or non-finite components, and rows with a null label, link with
    nothing (n_links 0, their own component). Vectors of different lengths don't link. Repeated rows are copies; a null
    id gets component null and is not kept. Other columns are not carried.
    """
    spark = vectors.sparkSession
    base = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.transform(vec_col, lambda v: v.cast("double")).alias("v"),
    )
    some = F.exists("v", lambda v: v != 0)
    fit = usable(base, "v") & F.coalesce(some, F.lit(False)) & F.col("label").isNotNull()
    base = base.withColumn("class", F.when(fit, F.sha2(F.to_json(F.struct("label", "v")).cast("binary"), 256)))
    base = table(base, "vectors")
    classes = base.filter("class is not null").groupBy("class").agg(
        F.min("id").alias("low"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("v").alias("v")
    )
    classes = table(classes, "classes")
    total = classes.count()
    share = min(1.0, 0.9 * sample_rows / max(1, total))
    chosen = F.pmod(F.xxhash64("class"), F.lit(1_000_000)) < int(share * 1_000_000)
    sample = classes.filter(chosen).limit(sample_rows).select("v").toPandas()["v"]
    dims = pd.Series([len(v) for v in sample]).mode()
    dims = int(dims.iloc[0]) if len(dims) else 2
    unit = unit_rows(np.array([v for v in sample if len(v) == dims]).reshape(-1, dims))
    size = int(min(most_centres, max(1, round((total / rows_per_cell) ** 0.5))))
    books = (fit_codebook(unit[:, : dims // 2], size), fit_codebook(unit[:, dims // 2 :], size))
    full = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    reach = measured_reach(classes, total, books, dims, threshold, target_recall) if target_recall < 1 and len(books[0]) * len(books[1]) > 1 else full
    shared = spark.sparkContext.broadcast(books)

    def make():
        first, second = shared.value

        def function(columns):
            out = {k: [] for k in ("class", "label", "v", "own", "cell", "copies")}
            for dims_here in set(map(len, columns["v"])):
                at = [i for i, v in enumerate(columns["v"]) if len(v) == dims_here]
                x = np.array([columns["v"][i] for i in at])
                x = unit_rows(x)
                if dims_here == dims:
                    (a, wall_a), (b, wall_b) = walls(x[:, : dims // 2], first), walls(x[:, dims // 2 :], second)
                    own = a * len(second) + b
                    cells = [[i * len(second) + j for i, j in multi_sequence(p, q, reach)] for p, q in zip(wall_a, wall_b, strict=True)]
                else:  # another length than most: one cell a length, compared whole
                    own = np.full(len(x), -dims_here)
                    cells = [[-dims_here]] * len(x)
                for i, v, o, cs in zip(at, x, own, cells, strict=True):
                    for c in {int(o), *cs}:
                        if c >= o:
                            for k, value in (("class", columns["class"][i]), ("label", columns["label"][i]), ("v", v.tobytes()), ("own", int(o)), ("cell", c), ("copies", columns["copies"][i])):
                                out[k].append(value)
            return out

        return function

    probes = map_rows(classes.select("class", "label", "v", "copies"), "class string, label string, v binary, own int, cell int, copies long", make)
    probes = table(probes, "probes")
    at_cell = ["label", "cell"]
    loads = probes.groupBy(*at_cell).agg(F.count("*").alias("asked"), F.sum((F.col("own") == F.col("cell")).cast("int")).alias("members"))
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / CELL_ROWS)).cast("int")
    loads = loads.filter("members > 0").select(*at_cell, blocks("asked").alias("na"), blocks("members").alias("nm"))
    placed = probes.join(loads, at_cell)
    h = F.xxhash64("class")
    as_probe = placed.withColumn("pa", F.pmod(h, F.col("na")).cast("int")).withColumn("pm", F.explode(F.sequence(F.lit(0), F.col("nm") - 1)))
    as_member = placed.filter("own = cell").withColumn("pm", F.pmod(h, F.col("nm")).cast("int")).withColumn("pa", F.explode(F.sequence(F.lit(0), F.col("na") - 1)))
    columns = [*at_cell, "pm", "pa", "class", "v", "own", "copies"]
    dealt = as_probe.select(*columns, F.lit(True).alias("probe")).unionByName(as_member.select(*columns, F.lit(False).alias("probe")))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        p, m = group[group["probe"]], group[~group["probe"]]
        empty = pd.DataFrame([], columns=["class", "links", "other"], dtype=object)
        if p.empty or m.empty:
            return empty
        x, y = (np.frombuffer(b"".join(g["v"]), "f8").reshape(len(g), -1) for g in (p, m))
        near = x @ y.T >= threshold
        home = (p["own"] == p["cell"]).to_numpy()
        pc, mc = (np.array(g["class"].to_list(), object) for g in (p, m))
        near &= ~home[:, None] | (pc[:, None] < mc[None])
        if not near.any():
            return empty
        links_p, links_m = near @ m["copies"].to_numpy(), near.T @ p["copies"].to_numpy()
        root_p, root_m = _roots(near)
        rows = [(pc[i], int(links_p[i]), pc[root_p[i]]) for i in np.flatnonzero(links_p)]
        rows += [(mc[j], int(links_m[j]), pc[root_m[j]]) for j in np.flatnonzero(links_m)]
        return pd.DataFrame(rows, columns=["class", "links", "other"], dtype=object)

    met = table(dealt.groupBy(*at_cell, "pm", "pa").applyInPandas(compare, "class string, links long, other string"), "links")
    links = met.groupBy("class").agg(F.sum("links").alias("links"))
    joined = components(met, "class", "other")
    named = joined.join(classes.select(F.col("class").alias("node"), "low"), "node")
    lowest = named.groupBy("root").agg(F.min("low").alias("component"))
    of = named.join(lowest, "root").select(F.col("node").alias("class"), "component")
    facts = classes.select("class", "low", "copies").join(links, "class", "left").join(of, "class", "left").select(
        "class", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "low").alias("component")
    )
    out = base.select("id", "class").join(facts, "class", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def _roots(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the bipartite graph of a 0/1 matrix, the smallest row of each row's and each column's component."""
    rows, none = np.arange(len(near)), len(near)
    while True:
        columns = np.where(near, rows[:, None], none).min(0)
        low = np.minimum(rows, np.where(near, columns[None], none).min(1))
        if (low == rows).all():
            return rows, columns
        rows = low
