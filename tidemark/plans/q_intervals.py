"""Queries on intervals: filters on reads and regions, overlap joins, merges, coverage, windows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import intervals as iv
from . import views as v
from .registry import query

ROUND = 6


@query("fil8_unique_mappers", v.sql("reads", 'SELECT event_id, chrom, start, "end", strand, weight FROM reads WHERE weight >= 1.0'))
def fil8(spark, sf):
    return v.reads(spark, sf).filter("weight >= 1.0").select("event_id", "chrom", "start", "end", "strand", "weight")


@query(
    "fil9_strand_shift",
    v.sql("reads", """, moved AS (SELECT event_id, chrom, strand, CASE WHEN strand = '+' THEN start + 75 ELSE start - 75 END AS start,
  CASE WHEN strand = '+' THEN "end" + 75 ELSE "end" - 75 END AS "end" FROM reads) SELECT * FROM moved WHERE start > 0"""),
)
def fil9(spark, sf):
    return strand_shift(v.reads(spark, sf), 150).select("event_id", "chrom", "strand", "start", "end")


def strand_shift(reads, length: int):
    """Reads moved by half the fragment length, + to the right and - to the left; those that would begin at 0 or before leave."""
    by = F.when(F.col("strand") == "+", F.lit(length // 2)).otherwise(F.lit(-(length // 2)))
    moved = reads.withColumn("start", F.col("start") + by).withColumn("end", F.col("end") + by)
    return moved.filter("start > 0")


@query(
    "fil10_fragment_extension",
    v.sql("reads", """, x AS (SELECT event_id, chrom, strand, CASE WHEN strand = '+' THEN start - 75 ELSE "end" - 75 END AS a,
  CASE WHEN strand = '+' THEN start + 75 ELSE "end" + 75 END AS b FROM reads)
  SELECT event_id, chrom, strand, greatest(a, 0) AS start, CASE WHEN b <= 0 THEN 1 ELSE b END AS "end" FROM x"""),
)
def fil10(spark, sf):
    five = F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("end"))
    end = five + 75
    return v.reads(spark, sf).select(
        "event_id", "chrom", "strand", F.greatest(five - 75, F.lit(0)).alias("start"), F.when(end <= 0, F.lit(1)).otherwise(end).alias("end")
    )


@query(
    "fil11_resize_regions",
    v.sql("regions", """SELECT region_id, chrom, start - CAST(trunc((1000 - ("end" - start)) / 2.0) AS BIGINT) AS start,
  "end" + CAST(trunc((1000 - ("end" - start)) / 2.0) AS BIGINT) AS "end" FROM regions"""),
)
def fil11(spark, sf):
    by = F.expr("(1000 - (end - start)) div 2")
    return v.regions(spark, sf).select("region_id", "chrom", (F.col("start") - by).alias("start"), (F.col("end") + by).alias("end"))


@query(
    "fil12_midpoint_regions",
    v.sql("regions", """SELECT region_id, chrom, greatest(0, (start + "end") // 2 - 250) AS start, (start + "end") // 2 + 250 AS "end" FROM regions"""),
)
def fil12(spark, sf):
    mid = F.expr("(start + end) div 2")
    return v.regions(spark, sf).select("region_id", "chrom", F.greatest(F.lit(0), mid - 250).alias("start"), (mid + 250).alias("end"))


def read_regions(spark, sf, **how):
    """All reads with the regions they overlap: places of reads and regions meet, then their rows."""
    names = ["chrom", "start", "end", "strand"]
    return iv.overlaps_by_place(v.reads(spark, sf).select("event_id", *names), v.regions(spark, sf).select("region_id", *names), **how)


@query(
    "joi1_overlap_join",
    v.sql("reads regions", """SELECT r.event_id, g.region_id FROM reads r JOIN regions g ON r.chrom = g.chrom AND r.start < g."end" AND g.start < r."end" """),
)
def joi1(spark, sf):
    return read_regions(spark, sf).select("event_id", F.col("r_region_id").alias("region_id"))


@query(
    "joi2_min_overlap_stranded",
    v.sql("reads regions", """SELECT r.event_id, g.region_id, least(r."end", g."end") - greatest(r.start, g.start) AS shared FROM reads r
  JOIN regions g ON r.chrom = g.chrom AND r.strand = g.strand AND least(r."end", g."end") - greatest(r.start, g.start) >= 20"""),
)
def joi2(spark, sf):
    found = read_regions(spark, sf, least=20, stranded=True)
    return found.select("event_id", F.col("r_region_id").alias("region_id"), (F.least("end", "r_end") - F.greatest("start", "r_start")).alias("shared"))


_ISLANDS = """, o AS (SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM {t}),
i AS (SELECT *, sum(CASE WHEN before IS NULL OR start > before + {slack} THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM o)"""


def _few(spark, sf):
    """The called regions: those whose score is above the cutoff."""
    return v.regions(spark, sf).filter("score > 45")


_FEW = ", few AS (SELECT * FROM regions WHERE score > 45)"


@query(
    "joi3_subtract_intervals",
    v.sql("regions", _FEW + _ISLANDS.format(t="few", slack=0) + """, m AS (SELECT chrom, island, min(start) AS s, max("end") AS e FROM i GROUP BY ALL),
  hit AS (SELECT r.region_id, r.start, r."end", greatest(m.s, r.start) AS hs, least(m.e, r."end") AS he FROM regions r
    JOIN m ON r.chrom = m.chrom AND r.start < m.e AND m.s < r."end" WHERE r.score <= 45),
  cut AS (SELECT region_id, start AS s0, "end" AS e0, hs, he, row_number() OVER (PARTITION BY region_id ORDER BY hs) AS k,
    coalesce(lead(hs) OVER (PARTITION BY region_id ORDER BY hs), "end") AS after FROM hit),
  parts AS (SELECT region_id, s0 AS start, hs AS "end" FROM cut WHERE k = 1 AND s0 < hs UNION ALL SELECT region_id, he, after FROM cut WHERE he < after)
  SELECT region_id, start, "end" FROM parts UNION ALL SELECT region_id, start, "end" FROM regions WHERE score <= 45 AND region_id NOT IN (SELECT region_id FROM hit)"""),
)
def joi3(spark, sf):
    few = _few(spark, sf)
    return iv.subtract(v.regions(spark, sf).filter("score <= 45"), few, "region_id", tile=iv.tile_width(few, ["chrom"]))


@query(
    "joi4_repeat_anti_join",
    v.sql("reads regions", _FEW + """, p AS (SELECT *, CASE WHEN strand = '+' THEN start ELSE "end" - 1 END AS pos FROM reads)
  SELECT event_id, chrom, pos FROM p WHERE NOT EXISTS (SELECT 1 FROM few f WHERE f.chrom = p.chrom AND f.start <= p.pos AND p.pos < f."end")"""),
)
def joi4(spark, sf):
    """Reads whose 5' end lies in no repeat: the union of the repeats is binned, so a read meets at most a few intervals."""
    five = v.reads(spark, sf).select("event_id", "chrom", F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("end") - 1).alias("pos"))
    points = five.select("event_id", "chrom", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"))
    few = _few(spark, sf)
    within = iv.overlaps(points, iv.merged(few, ["chrom"], tile=iv.tile_width(few, ["chrom"])).select("chrom", "start", "end")).select("event_id")
    return five.join(within, "event_id", "left_anti")


def strand_shifts(reads, most: int):
    """Pairs of a plus 5' end and a minus 5' end that lies 0 to ``most`` positions to the right, by their distance, zeros included."""
    ends = reads.select("chrom", "strand", F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("end") - 1).alias("pos"))
    counts = ends.groupBy("chrom", "strand", "pos").agg(F.count("*").alias("n"))
    width = most + 1
    plus = counts.filter("strand = '+'").select("chrom", F.col("pos").alias("p"), F.col("n").alias("np"))
    plus = plus.withColumn("bin", F.explode(F.array(F.floor(F.col("p") / width), F.floor(F.col("p") / width) + 1)))
    minus = counts.filter("strand = '-'").select("chrom", F.col("pos").alias("m"), F.col("n").alias("nm"), F.floor(F.col("pos") / width).alias("bin"))
    delta = (F.col("m") - F.col("p")).alias("delta")
    met = plus.join(minus, ["chrom", "bin"]).filter(F.col("m").between(F.col("p"), F.col("p") + most))
    found = met.groupBy(delta).agg(F.sum(F.col("np") * F.col("nm")).alias("pairs"))
    every = reads.sparkSession.range(most + 1).withColumnRenamed("id", "delta")
    return every.join(found, "delta", "left").select("delta", F.coalesce("pairs", F.lit(0)).alias("pairs"))


@query(
    "joi5_strand_cross_correlation",
    v.sql("reads", """, p AS (SELECT chrom, strand, CASE WHEN strand = '+' THEN start ELSE "end" - 1 END AS pos FROM reads),
  x AS (SELECT b.pos - a.pos AS delta, count(*) AS pairs FROM p a JOIN p b ON a.chrom = b.chrom AND a.strand = '+' AND b.strand = '-'
    AND b.pos BETWEEN a.pos AND a.pos + 600 GROUP BY 1)
  SELECT d.delta, coalesce(x.pairs, 0) AS pairs FROM (SELECT unnest(range(601)) AS delta) d LEFT JOIN x ON x.delta = d.delta"""),
)
def joi5(spark, sf):
    return strand_shifts(v.reads(spark, sf), 600)


@query(
    "joi6_nearest_window",
    v.sql("reads regions", """, w AS (SELECT chrom, start // 250 * 250 + 125 AS middle, min(start // 250) AS win FROM reads WHERE weight > 1.5 GROUP BY 1, 2),
  g AS (SELECT region_id, chrom, (start + "end") // 2 AS middle FROM regions),
  r AS (SELECT region_id, w.middle AS near, abs(w.middle - g.middle) AS distance, row_number() OVER (PARTITION BY region_id ORDER BY abs(w.middle - g.middle), w.middle) AS k
    FROM g JOIN w ON w.chrom = g.chrom)
  SELECT region_id, CAST(near AS VARCHAR) AS near_id, CAST(distance AS DOUBLE) AS distance FROM r WHERE k = 1"""),
)
def joi6(spark, sf):
    windows = v.reads(spark, sf).filter("weight > 1.5").selectExpr("chrom", "start div 250 * 250 + 125 as middle").distinct()
    peaks = v.regions(spark, sf).selectExpr("region_id", "chrom", "(start + end) div 2 as middle")
    return iv.nearest(peaks, windows.withColumn("win", F.col("middle").cast("string")), "region_id", "win", tile=iv.tile_width(peaks, ["chrom"], "middle"))


@query(
    "joi7_three_nearest_each_side",
    v.sql("regions", """, a AS (SELECT region_id, chrom, (start + "end") // 2 AS middle FROM regions WHERE strand = '+'),
  b AS (SELECT region_id AS gene, chrom, (start + "end") // 2 AS middle FROM regions WHERE strand = '-'),
  p AS (SELECT a.region_id, b.gene, b.middle - a.middle AS delta, CASE WHEN b.middle <= a.middle THEN 'left' ELSE 'right' END AS side FROM a JOIN b ON a.chrom = b.chrom),
  r AS (SELECT *, row_number() OVER (PARTITION BY region_id, side ORDER BY abs(delta), gene) AS k FROM p),
  e AS (SELECT region_id, side, rank FROM a, (SELECT unnest(['left', 'right']) AS side), (SELECT unnest([1, 2, 3]) AS rank))
  SELECT e.region_id, e.side, CAST(e.rank AS INTEGER) AS rank, r.gene, r.delta FROM e LEFT JOIN r ON r.region_id = e.region_id AND r.side = e.side AND r.k = e.rank"""),
)
def joi7(spark, sf):
    """Peaks (the + regions) with the next three genes (the - regions) on either side, null where there are fewer."""
    a = v.regions(spark, sf).filter("strand = '+'").selectExpr("region_id", "chrom", "(start + end) div 2 as middle")
    b = v.regions(spark, sf).filter("strand = '-'").selectExpr("region_id as gene", "chrom", "(start + end) div 2 as middle")
    every = v.regions(spark, sf).selectExpr("chrom", "(start + end) div 2 as middle")
    return iv.nearest_sides(a, b, 3, tile=iv.tile_width(every, ["chrom"], "middle"))


@query(
    "joi16_range_lookups",
    v.sql("regions", """SELECT region_id, chrom, start, "end", CASE WHEN start >= 5000 AND "end" <= 9000 THEN 'inside' ELSE 'overlap' END AS how
  FROM regions WHERE start < 9000 AND "end" > 5000"""),
)
def joi16(spark, sf):
    how = F.when((F.col("start") >= 5000) & (F.col("end") <= 9000), "inside").otherwise("overlap")
    return v.regions(spark, sf).filter("start < 9000 and end > 5000").select("region_id", "chrom", "start", "end", how.alias("how"))


@query(
    "agg1_collapse_five_prime",
    v.sql("reads", """SELECT chrom, CASE WHEN strand = '+' THEN start ELSE "end" - 1 END AS start, CASE WHEN strand = '+' THEN start ELSE "end" - 1 END + 1 AS "end",
  strand, round(sum(weight), 6) AS weight FROM reads GROUP BY ALL"""),
)
def agg1(spark, sf):
    return collapse(v.reads(spark, sf)).select("chrom", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), "strand", F.round("weight", ROUND).alias("weight"))


def collapse(reads):
    """Sum of weights by 5' end: ``chrom, pos, strand, weight``."""
    five = F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("end") - 1)
    return reads.groupBy("chrom", five.alias("pos"), "strand").agg(F.sum("weight").alias("weight"))


_WINDOWS = """, p AS (SELECT chrom, role, replicate, weight, CASE WHEN strand = '+' THEN start ELSE "end" - 1 END AS pos FROM reads),
  n AS (SELECT unnest(range(0, (43200 - 500) // 250 + 1)) AS win),
  c AS (SELECT DISTINCT chrom FROM reads),
  counted AS (SELECT c.chrom, n.win, p.role || '_' || p.replicate AS sample, sum(p.weight) AS total FROM c CROSS JOIN n JOIN p ON p.chrom = c.chrom
    AND CASE WHEN p.role = 'fg' THEN p.pos >= n.win * 250 AND p.pos < n.win * 250 + 500
        ELSE p.pos >= n.win * 250 + 250 - 1000 AND p.pos < n.win * 250 + 250 + 1000 END GROUP BY ALL),
  windows AS (SELECT chrom, win * 250 AS start, win * 250 + 500 AS stop, win * 250 + 250 AS middle,
    round(coalesce(sum(total) FILTER (sample = 'fg_0'), 0), 6) AS fg_0, round(coalesce(sum(total) FILTER (sample = 'fg_1'), 0), 6) AS fg_1,
    round(coalesce(sum(total) FILTER (sample = 'bg_0'), 0), 6) AS bg_0, round(coalesce(sum(total) FILTER (sample = 'bg_1'), 0), 6) AS bg_1 FROM counted GROUP BY ALL)"""


def windows(spark, sf):
    """Foreground counts in windows of 500 every 250, background counts in 2000 around the same centre, a column a sample; no all-zero rows."""
    five = F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("end") - 1)
    reads = v.reads(spark, sf).select("chrom", "role", F.concat_ws("_", "role", "replicate").alias("sample"), "weight", five.alias("pos"))
    fg = iv.window_counts(reads.filter("role = 'fg'"), F.lit(v.SPAN), 500, 250, groups=("sample",))
    bg = iv.window_counts(reads.filter("role = 'bg'"), F.lit(v.SPAN), 2000, 250, inner=500, groups=("sample",))
    samples = ["fg_0", "fg_1", "bg_0", "bg_1"]
    wide = fg.unionByName(bg).groupBy("chrom", "window").pivot("sample", samples).agg(F.sum("total"))
    start = F.col("window") * 250
    return wide.select("chrom", start.alias("start"), (start + 500).alias("stop"), (start + 250).alias("middle"), *[F.round(F.coalesce(s, F.lit(0.0)), ROUND).alias(s) for s in samples])


@query("agg3_sliding_windows", v.sql("reads", _WINDOWS + " SELECT * FROM windows"))
def agg3(spark, sf):
    return windows(spark, sf)


@query("fil13_background_filter", v.sql("reads", _WINDOWS + " SELECT * FROM windows WHERE bg_0 + bg_1 < 60"))
def fil13(spark, sf):
    return windows(spark, sf).filter("bg_0 + bg_1 < 60")


@query(
    "fil13_background_filter_report",
    v.sql("reads", _WINDOWS + " SELECT count(*) AS windows, count(*) FILTER (bg_0 + bg_1 >= 60) AS dropped, round(100.0 * count(*) FILTER (bg_0 + bg_1 >= 60) / count(*), 6) AS percent FROM windows"),
)
def fil13_report(spark, sf):
    """How many windows the background filter drops."""
    dropped = F.count_if(F.expr("bg_0 + bg_1 >= 60"))
    return windows(spark, sf).agg(F.count("*").alias("windows"), dropped.alias("dropped"), F.round(100.0 * dropped / F.count("*"), 6).alias("percent"))


@query(
    "fil14_combined_cut",
    v.sql("reads", _WINDOWS + " SELECT chrom, start, fg_0 + fg_1 AS score FROM windows WHERE bg_0 + bg_1 <= 80 AND fg_0 + fg_1 > 5"),
)
def fil14(spark, sf):
    cut = windows(spark, sf).filter("bg_0 + bg_1 <= 80 and fg_0 + fg_1 > 5")
    return cut.selectExpr("chrom", "start", "fg_0 + fg_1 as score").orderBy(F.desc("score"), "chrom", "start")


_PILE = """, pairs AS (SELECT g.region_id, g.start AS gs, g."end" AS ge, r.start AS rs, r."end" AS re, r.weight, r.replicate FROM regions g
    JOIN reads r ON r.chrom = g.chrom AND r.start < g."end" AND g.start < r."end"),
  pile AS (SELECT region_id, replicate, unnest(range(greatest(rs, gs), least(re, ge))) AS p, weight FROM pairs)"""


def profiles(found, over=None):
    """``region_id, cov``: a region's coverage (over a column's value, if any) in ten-thousandths from its first position to its last, an array as long as the region, worked out once a place."""
    whole = lambda x: F.round(x * 10_000).cast("long")
    # A column named in the function of a position would be worked out again at each position, as Catalyst puts its expression there; a list of it is made once a row.
    cov = F.transform("cov", whole) if over is None else F.zip_with("cov", F.array_repeat(over, F.size("cov")), lambda x, n: whole(x / n))
    each = found.select("ids", cov.alias("cov"))
    return each.select(F.explode("ids").alias("region_id"), "cov")


@query(
    "agg4_region_coverage",
    v.sql("reads regions", _PILE + """, c AS (SELECT region_id, p, sum(weight) AS cov FROM pile GROUP BY ALL), b AS (SELECT region_id, unnest(range(gs, ge)) AS p FROM (SELECT DISTINCT region_id, gs, ge FROM pairs))
  SELECT b.region_id, list(CAST(round(coalesce(cov, 0) * 10000) AS BIGINT) ORDER BY b.p) AS cov FROM b LEFT JOIN c ON c.region_id = b.region_id AND c.p = b.p GROUP BY 1"""),
)
def agg4(spark, sf):
    """Coverage of every position of every region that has reads, zeros included."""
    return profiles(iv.place_coverage(v.reads(spark, sf), v.regions(spark, sf), "region_id", "weight"))


@query(
    "agg5_replicate_mean_coverage",
    v.sql("reads regions", _PILE + """, c AS (SELECT region_id, replicate, p, sum(weight) AS cov FROM pile GROUP BY ALL), b AS (SELECT region_id, replicate, unnest(range(gs, ge)) AS p FROM (SELECT DISTINCT region_id, replicate, gs, ge FROM pairs)),
  o AS (SELECT b.region_id, b.p, avg(coalesce(cov, 0)) AS cov FROM b LEFT JOIN c ON c.region_id = b.region_id AND c.replicate = b.replicate AND c.p = b.p GROUP BY ALL)
  SELECT region_id, list(CAST(round(cov * 10000) AS BIGINT) ORDER BY p) AS cov FROM o GROUP BY 1"""),
)
def agg5(spark, sf):
    """Mean over the replicates that have the region: their coverage together, over their number."""
    return profiles(iv.place_coverage(v.reads(spark, sf), v.regions(spark, sf), "region_id", "weight", group="replicate"), "groups")


@query(
    "agg6_stepped_genome_coverage",
    v.sql("reads", """, m AS (SELECT chrom, greatest(start + 1 + CASE WHEN strand = '+' THEN 5 ELSE -5 END, 1) AS a, greatest("end" + CASE WHEN strand = '+' THEN 5 ELSE -5 END, greatest(start + 1 + CASE WHEN strand = '+' THEN 5 ELSE -5 END, 1)) AS z, weight FROM reads),
  s AS (SELECT chrom, max(z) AS size FROM m GROUP BY 1), b AS (SELECT chrom, unnest(range(a, z + 1)) AS p, weight FROM m), c AS (SELECT chrom, p, sum(weight) AS cov FROM b GROUP BY ALL),
  q AS (SELECT chrom, size, unnest(range(1, greatest(size - 10, 1) + 1, 10)) AS pos FROM s),
  w AS (SELECT q.chrom, q.pos, coalesce(sum(c.cov), 0) / (least(q.pos - 5 + 9, q.size) - greatest(q.pos - 5, 1) + 1) AS mean FROM q LEFT JOIN c ON c.chrom = q.chrom AND c.p BETWEEN q.pos - 5 AND q.pos + 4 GROUP BY q.chrom, q.pos, q.size)
  SELECT chrom, pos, round(log2(mean + 1), 5) AS level FROM w WHERE mean > 0 OR pos = 1"""),
)
def agg6(spark, sf):
    """Mean coverage by shifted reads in windows of 10 around every tenth position, position 1 always."""
    return iv.stepped_coverage(v.reads(spark, sf), 10, shift=5).select("chrom", "pos", F.round(F.log2(F.col("mean") + 1), 5).alias("level"))


@query(
    "agg12_merge_windows",
    v.sql("regions", _FEW + _ISLANDS.format(t="few", slack=0) + """, m AS (SELECT chrom, min(start) AS start, max("end") AS "end", max(score) AS score, count(*) AS n FROM i GROUP BY chrom, island)
  SELECT chrom, start, "end", score, n, 'reg' || (1000000 + row_number() OVER (ORDER BY score DESC, chrom, start) - 1) AS merged_id FROM m ORDER BY score DESC, chrom, start LIMIT 1000"""),
)
def agg12(spark, sf):
    few = _few(spark, sf)
    return top_regions(iv.merged(few, ["chrom"], tile=iv.tile_width(few, ["chrom"]), score=F.max("score")), 1000)


def top_regions(runs, k: int):
    """The k regions of largest score with the ids reg1000000, reg1000001 ...: the limit comes before the numbering, so one task numbers k rows."""
    best = runs.orderBy(F.desc("score"), "chrom", "start").limit(k)
    rank = F.row_number().over(Window.orderBy(F.desc("score"), "chrom", "start"))
    return best.withColumn("merged_id", F.concat(F.lit("reg"), (rank + 999_999).cast("string")))


@query(
    "agg13_clusters_with_slack",
    v.sql("regions scattered", _ISLANDS.format(t="scattered", slack=2) + """ SELECT chrom, min(start) AS start, max("end") AS "end", count(*) AS n FROM i GROUP BY chrom, island"""),
)
def agg13(spark, sf):
    rows = v.scattered(spark, sf)
    return iv.merged(rows, ["chrom"], slack=2, tile=iv.tile_width(rows, ["chrom"]))


def _fold(view: str, joins: str) -> str:
    """SQL of a fold over each sequence, row by row; ``joins`` says whether a row ``r`` joins the cluster with span ``f.s`` to ``f.e``."""
    return v.sql("regions scattered", f""", r AS (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY start, "end", region_id) AS k FROM {view})""").replace("WITH ", "WITH RECURSIVE ", 1) + f""",
  f AS (SELECT chrom, k, region_id, start, "end", start AS s, "end" AS e, region_id AS c FROM r WHERE k = 1
    UNION ALL SELECT r.chrom, r.k, r.region_id, r.start, r."end", CASE WHEN {joins} THEN least(f.s, r.start) ELSE r.start END, CASE WHEN {joins} THEN greatest(f.e, r."end") ELSE r."end" END, CASE WHEN {joins} THEN f.c ELSE r.region_id END
    FROM f JOIN r ON r.chrom = f.chrom AND r.k = f.k + 1)
  SELECT chrom, region_id, start, "end", c AS cluster, s AS cluster_start FROM f"""


def apart_by(slack: int):
    """Predicate of clusters: at most ``slack`` positions between a row and the span."""
    return lambda start, end, low, high: start <= high + slack and low <= end + slack


def contains(start: int, end: int, low: int, high: int) -> bool:
    """Predicate of clusters: a row lies wholly in the span, or the span in the row."""
    return low <= start and end <= high or start <= low and high <= end


@query("agg13_cluster_members", _fold("scattered", 'r.start <= f.e + 2 AND f.s <= r."end" + 2'))
def agg13_members(spark, sf):
    """A row for each region with its cluster, by a caller's predicate on the span so far: here overlap with two positions of slack."""
    rows = v.scattered(spark, sf)
    return iv.clusters(rows, ["chrom"], "region_id", apart_by(2), tile=iv.tile_width(rows, ["chrom"]))


@query("agg13_contained_clusters", _fold("regions", '(f.s <= r.start AND r."end" <= f.e OR r.start <= f.s AND f.e <= r."end")'))
def agg13_contained(spark, sf):
    """The same with containment, either way, instead of overlap, on the busy sequences."""
    rows = v.regions(spark, sf)
    return iv.clusters(rows, ["chrom"], "region_id", contains, tile=iv.tile_width(rows, ["chrom"]))


@query(
    "agg14_complement",
    v.sql("regions scattered", _ISLANDS.format(t="scattered", slack=0) + """, m AS (SELECT chrom, min(start) AS s, max("end") AS e FROM i GROUP BY chrom, island),
  g AS (SELECT chrom, lag(e) OVER (PARTITION BY chrom ORDER BY s) AS start, s AS "end" FROM m) SELECT * FROM g WHERE start < "end" """),
)
def agg14(spark, sf):
    rows = v.scattered(spark, sf)
    return iv.gaps(rows, tile=iv.tile_width(rows, ["chrom"]))


@query(
    "agg15_promoter_regions",
    v.sql("regions scattered", """, p AS (SELECT region_id, chrom, strand, CASE WHEN strand = '+' THEN start ELSE "end" END AS tss FROM scattered),
  g AS (SELECT chrom, strand, tss, CASE WHEN strand = '+' THEN greatest(0, tss - 200) ELSE greatest(0, tss - 50) END AS start, CASE WHEN strand = '+' THEN tss + 50 ELSE tss + 200 END AS "end", count(*) AS own FROM p GROUP BY chrom, strand, tss),
  o AS (SELECT *, max("end") OVER (PARTITION BY chrom, strand ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM g),
  i AS (SELECT *, sum(CASE WHEN before IS NULL OR start > before THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, strand ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM o),
  m AS (SELECT chrom, strand, island, min(start) AS start, max("end") AS "end", count(*) AS starts, CAST(sum(own) AS BIGINT) AS n FROM i GROUP BY chrom, strand, island)
  SELECT m.chrom, m.strand, m.start, m."end", m.starts, m.n, p.region_id FROM m JOIN i ON i.chrom = m.chrom AND i.strand = m.strand AND i.island = m.island JOIN p ON p.chrom = i.chrom AND p.strand = i.strand AND p.tss = i.tss"""),
)
def agg15(spark, sf):
    """Promoters of transcripts: those of one start first become one, then overlapping ones of a strand; a row a transcript with its promoter region, so no list grows with a region."""
    plus, at = F.col("strand") == "+", ["chrom", "strand"]
    genes = v.scattered(spark, sf).select(*at, F.when(plus, F.col("start")).otherwise(F.col("end")).alias("tss"), "region_id")
    starts = genes.groupBy(*at, "tss").agg(F.count("*").alias("own"))
    start = F.greatest(F.lit(0), F.when(plus, F.col("tss") - 200).otherwise(F.col("tss") - 50))
    spans = starts.select(*at, "tss", start.alias("start"), F.when(plus, F.col("tss") + 50).otherwise(F.col("tss") + 200).alias("end"), "own")
    runs = iv.written(iv.merge(spans, at), "promoters")
    whole = runs.groupBy(*at, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("starts"), F.sum("own").alias("n"))
    return runs.select(*at, "island", "tss").join(whole, [*at, "island"]).join(genes, [*at, "tss"]).select(*at, "start", "end", "starts", "n", "region_id")


@query(
    "fun1_multiplicity_weight",
    v.sql("reads", "SELECT event_id, CAST(n AS DOUBLE) / hits AS weight FROM reads WHERE hits <= 3"),
)
def fun1(spark, sf):
    return v.reads(spark, sf).filter("hits <= 3").selectExpr("event_id", "cast(n as double) / hits as weight")


@query(
    "fun2_row_replication",
    v.sql("reads", "SELECT event_id, unnest(range(CAST(floor(weight + 0.5) AS BIGINT))) AS copy FROM reads"),
)
def fun2(spark, sf):
    copies = F.floor(F.col("weight") + 0.5)
    return v.reads(spark, sf).filter(copies > 0).select("event_id", F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1)).alias("copy"))


@query(
    "fun3_relative_interval",
    v.sql("reads regions", """ SELECT r.event_id, g.region_id, CASE WHEN r.strand = g.strand THEN '+' ELSE '-' END AS strand,
  CASE WHEN g.strand = '+' THEN r.start - g.start ELSE g."end" - r."end" END AS start, CASE WHEN g.strand = '+' THEN r."end" - g.start ELSE g."end" - r.start END AS "end"
  FROM reads r JOIN regions g ON r.chrom = g.chrom AND r.start < g."end" AND g.start < r."end" """),
)
def fun3(spark, sf):
    found, plus = read_regions(spark, sf), F.col("r_strand") == "+"
    return found.select(
        "event_id", F.col("r_region_id").alias("region_id"), F.when(F.col("strand") == F.col("r_strand"), "+").otherwise("-").alias("strand"),
        F.when(plus, F.col("start") - F.col("r_start")).otherwise(F.col("r_end") - F.col("end")).alias("start"),
        F.when(plus, F.col("end") - F.col("r_start")).otherwise(F.col("r_end") - F.col("start")).alias("end"),
    )


_LOGRATIO = _WINDOWS + """, lr AS (SELECT chrom, start, stop AS "end", round(ln((fg_0 + fg_1 + 0.5) / (bg_0 + bg_1 + 0.5)), 6) AS score FROM windows WHERE bg_0 + bg_1 < 200),
  hot AS (SELECT * FROM lr WHERE score > -0.9)""" + _ISLANDS.format(t="hot", slack=0) + """, m AS (SELECT chrom, min(start) AS start, max("end") AS "end", max(score) AS score, count(*) AS n FROM i GROUP BY chrom, island)
  SELECT chrom, start, "end", score, n, 'reg' || (1000000 + row_number() OVER (ORDER BY score DESC, chrom, start) - 1) AS merged_id FROM m ORDER BY score DESC, chrom, start LIMIT 1000"""


@query("flagship_enriched_regions", v.sql("reads", _LOGRATIO))
def flagship(spark, sf):
    """Reads to 5' ends, windows, background filter, log ratio, merged windows above the cut, best 1000."""
    score = F.round(F.log((F.col("fg_0") + F.col("fg_1") + 0.5) / (F.col("bg_0") + F.col("bg_1") + 0.5)), ROUND)
    scored = windows(spark, sf).filter("bg_0 + bg_1 < 200").select("chrom", "start", F.col("stop").alias("end"), score.alias("score"))
    return top_regions(iv.merged(scored.filter("score > -0.9"), ["chrom"], score=F.max("score")), 1000)
