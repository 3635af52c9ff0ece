"""Queries on reads, tags and alignment hits."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import sequence as sq
from ..functions import trimming as tr
from . import views as v
from .registry import query

_QUAL = """, q AS (SELECT *, [ascii(x) - 33 FOR x IN string_split(qual, '') IF x <> ''] AS qs FROM fastq),
  s AS (SELECT *, {score} AS sc FROM q),
  m AS (SELECT *, coalesce(list_max([i FOR i IN range(1, len(sc) + 1) IF list_sum(sc[1:i]) >= 20.0 * i]), 0) AS keep FROM s),
  t AS (SELECT read_id, keep, substr(seq, 1, CAST(keep AS INTEGER)) AS trimmed, substr(qual, 1, CAST(keep AS INTEGER)) AS tq FROM m)
  SELECT read_id, trimmed, tq FROM t WHERE keep >= 25 AND len(trimmed) - len(replace(trimmed, 'N', '')) <= 2"""


@query("fil1_quality_trim", v.sql("fastq", _QUAL.format(score="qs")))
def fil1(spark, sf):
    return sq.quality_trim(v.fastq(spark, sf), lambda q: q.cast("double")).select("read_id", "trimmed", "tq")


@query("fil2_quality_trim_solexa", v.sql("fastq", _QUAL.format(score="[round(10 * log10(pow(10, x / 10.0) + 1), 9) FOR x IN qs]")))
def fil2(spark, sf):
    return sq.quality_trim(v.fastq(spark, sf), sq.solexa_to_phred).select("read_id", "trimmed", "tq")


@query(
    "fil3_detect_encoding",
    v.sql("fastq", """, c AS (SELECT unnest([ascii(x) FOR x IN string_split(qual, '') IF x <> '']) AS a FROM fastq)
  SELECT min(a) AS low, max(a) AS high, CASE WHEN max(a) > 74 THEN CASE WHEN min(a) < 64 THEN 'solexa' ELSE 'illumina' END ELSE 'sanger' END AS encoding,
  CASE WHEN max(a) > 74 THEN 64 ELSE 33 END AS base FROM c"""),
)
def fil3(spark, sf):
    codes = sq.ascii_codes(F.col("qual"))
    ends = v.fastq(spark, sf).filter("qual <> ''").select(F.array_min(codes).alias("low"), F.array_max(codes).alias("high"))
    one = ends.agg(F.min("low").alias("low"), F.max("high").alias("high"))
    kind = F.when(F.col("high") > 74, F.when(F.col("low") < 64, "solexa").otherwise("illumina")).otherwise("sanger")
    return one.select("low", "high", kind.alias("encoding"), F.when(F.col("high") > 74, 64).otherwise(33).alias("base"))


ADAPTOR = v.ADAPTOR


def _values(texts) -> str:
    return "[" + ", ".join(f"'{x}'" for x in texts) + "]"


_FULL3, _FULL5 = sq.variants(ADAPTOR, 1, indels=True, beyond="A"), sq.variants(ADAPTOR, 1, indels=True, five=True, beyond="C")


def _outermost(known: str, order: str, trimmed: str) -> str:
    """SQL of a full-length match: each place with the lengths L-1, L, L+1 in turn."""
    n = len(ADAPTOR)
    return f""", w AS (SELECT read_id, seq, unnest(range(1, len(seq) - {n} + 3)) AS p FROM tailed WHERE len(seq) >= {n - 1}),
  h AS (SELECT read_id, p, k FROM w, (SELECT unnest([{n - 1}, {n}, {n + 1}]) AS k) WHERE list_contains({known}, substr(seq, CAST(p AS INTEGER), CAST(k AS INTEGER)))),
  f AS (SELECT read_id, arg_min(struct_pack(p := p, k := k), struct_pack(a := {order}, b := k)) AS b FROM h GROUP BY 1)
  SELECT q.read_id, CASE WHEN b IS NULL THEN seq ELSE {trimmed} END AS trimmed FROM tailed q LEFT JOIN f ON f.read_id = q.read_id"""


@query("fil4_adaptor_full_length", v.sql("fastq tailed", _outermost(_values(_FULL3), "p", "substr(seq, 1, CAST(b.p AS INTEGER) - 1)")))
def fil4(spark, sf):
    """3' side: all before the leftmost adaptor within one change, gaps and insertions too."""
    return v.tailed(spark, sf).select("read_id", sq.trim_full(F.col("seq"), ADAPTOR, 1, indels=True, beyond="A").alias("trimmed"))


@query("fil4_adaptor_five_prime", v.sql("fastq tailed", _outermost(_values(_FULL5), "-p", "substr(seq, CAST(b.p + b.k AS INTEGER))")))
def fil4_five(spark, sf):
    """5' side: all behind the rightmost adaptor."""
    return v.tailed(spark, sf).select("read_id", sq.trim_full(F.col("seq"), ADAPTOR, 1, five=True, indels=True, beyond="C").alias("trimmed"))


def _most(k: int) -> int:
    """Letters replaced in a part of k letters: one from 7 on, two from 10 on."""
    return 2 if k >= 10 else 1


_PARTS = range(len(ADAPTOR) - 1, 6, -1)
_HAM = "list_sum([CASE WHEN x[1] <> x[2] THEN 1 ELSE 0 END FOR x IN list_zip(string_split({a}, ''), string_split({b}, ''))])"


def _partial(end: bool) -> str:
    a, b = ("right(seq, CAST(k AS INTEGER))", f"left('{ADAPTOR}', CAST(k AS INTEGER))") if end else ("left(seq, CAST(k AS INTEGER))", f"right('{ADAPTOR}', CAST(k AS INTEGER))")
    rest = "left(seq, CAST(len(seq) - f.k AS INTEGER))" if end else "substr(seq, CAST(f.k + 1 AS INTEGER))"
    return f""", w AS (SELECT read_id, seq, unnest(range(7, {len(ADAPTOR)})) AS k FROM tailed),
  h AS (SELECT read_id, k, {_HAM.format(a=a, b=b)} AS d FROM w WHERE len(seq) >= k), f AS (SELECT read_id, max(k) AS k FROM h WHERE d <= CASE WHEN k >= 10 THEN 2 ELSE 1 END GROUP BY 1)
  SELECT q.read_id, CASE WHEN f.k IS NULL THEN seq ELSE {rest} END AS trimmed FROM tailed q LEFT JOIN f ON f.read_id = q.read_id"""


@query("fil5_adaptor_partial", v.sql("fastq tailed", _partial(True)))
def fil5(spark, sf):
    """Longest prefix of the adaptor at the read's end, one letter replaced from 7 letters on, two from 10 on."""
    return v.tailed(spark, sf).select("read_id", sq.trim_partial(F.col("seq"), ADAPTOR, 7, _most).alias("trimmed"))


@query("fil5_adaptor_partial_five_prime", v.sql("fastq tailed", _partial(False)))
def fil5_five(spark, sf):
    return v.tailed(spark, sf).select("read_id", sq.trim_partial(F.col("seq"), ADAPTOR, 7, _most, five=True).alias("trimmed"))


_TAIL = "CASE " + " ".join(f"WHEN ends_with(seq, '{ADAPTOR[:k]}') THEN left(seq, len(seq) - {k})" for k in range(6, 0, -1)) + " ELSE seq END"
_HEAD = "CASE " + " ".join(f"WHEN starts_with(seq, '{ADAPTOR[-k:]}') THEN substr(seq, {k + 1})" for k in range(6, 0, -1)) + " ELSE seq END"


@query("fil6_adaptor_short_tail", v.sql("fastq tailed", f"SELECT read_id, {_TAIL} AS trimmed, {_HEAD} AS trimmed_five FROM tailed"))
def fil6(spark, sf):
    seq = F.col("seq")
    return v.tailed(spark, sf).select("read_id", sq.trim_tail(seq, ADAPTOR, 6).alias("trimmed"), sq.trim_tail(seq, ADAPTOR, 6, five=True).alias("trimmed_five"))


@query(
    "fil7_tag_filter_codes",
    v.sql("fastq", """, d AS (SELECT read_id, seq, [substr(seq, CAST(i AS INTEGER), 2) FOR i IN range(1, len(seq))] AS di FROM fastq),
  c AS (SELECT read_id, x, count(*) AS n FROM (SELECT read_id, unnest(di) AS x FROM d) GROUP BY ALL),
  e AS (SELECT read_id, -sum(n / t * ln(n / t) / ln(16)) / 0.9770337 AS h FROM (SELECT *, sum(n) OVER (PARTITION BY read_id) AS t FROM c) GROUP BY 1)
  SELECT d.read_id, CASE WHEN len(seq) < 14 THEN 1 WHEN len(seq) - len(replace(seq, 'N', '')) > 2 THEN 2 WHEN round(coalesce(h, 0), 9) < 0.5 THEN 3 ELSE 0 END AS code
  FROM d LEFT JOIN e ON e.read_id = d.read_id"""),
)
def fil7(spark, sf):
    return v.fastq(spark, sf).select("read_id", sq.tag_code(F.col("seq")).alias("code"))


@query(
    "fil15_hit_post_filter",
    v.sql("hits", """, f AS (SELECT * FROM hits WHERE "end" - start >= CASE err WHEN 0 THEN 14 WHEN 1 THEN 20 ELSE 24 END),
  c AS (SELECT seq_id, err, count(*) AS n FROM f GROUP BY ALL) SELECT seq_id, err, CASE WHEN n > 2 THEN -1 ELSE n END AS n_hits FROM c"""),
)
def fil15(spark, sf):
    least = F.element_at(F.array(F.lit(14), F.lit(20), F.lit(24)), F.col("err") + 1)
    counts = v.hits(spark, sf).filter(F.col("end") - F.col("start") >= least).groupBy("seq_id", "err").count()
    return counts.select("seq_id", "err", F.when(F.col("count") > 2, -1).otherwise(F.col("count")).alias("n_hits"))


@query("fil19_row_predicates", v.sql("hits", "SELECT seq_id, target_id, start FROM hits WHERE strand = '+' AND target_id IN (1, 3, 5, 7) AND start > 500 AND start < 2000"))
def fil19(spark, sf):
    return v.hits(spark, sf).filter((F.col("strand") == "+") & F.col("target_id").isin(1, 3, 5, 7) & (F.col("start") > 500) & (F.col("start") < 2000)).select("seq_id", "target_id", "start")


TARGET = 3000


@query(
    "fil21_down_sampling",
    v.sql("reads", f""", k AS (SELECT least(1.0, {TARGET}.0 / count(*)) AS share FROM reads),
  d AS (SELECT event_id, chrom, start, list_reduce([instr('0123456789abcdef', c) - 1 FOR c IN string_split(substr(md5(CAST(event_id AS VARCHAR)), 1, 6), '')], lambda a, b: a * 16 + b) AS h FROM reads)
  SELECT event_id, chrom, start FROM d, k WHERE share >= 0.9 OR h < share * 16777216"""),
)
def fil21(spark, sf):
    """About ``TARGET`` reads by a hash of the row's id, the same on any partitioning; all of them if that is nine tenths or more."""
    return down_sample(v.reads(spark, sf), TARGET, "event_id").select("event_id", "chrom", "start")


def down_sample(df, target: int, id_col: str):
    share = F.least(F.lit(1.0), F.lit(float(target)) / F.count("*")).alias("_share")
    draw = F.conv(F.substring(F.md5(F.col(id_col).cast("string").cast("binary")), 1, 6), 16, 10).cast("long")
    rows = df.withColumn("_draw", draw).join(F.broadcast(df.agg(share)))
    return rows.filter((F.col("_share") >= 0.9) | (F.col("_draw") < F.col("_share") * 16777216)).drop("_draw", "_share")


@query(
    "fil22_systematic_sampling",
    v.sql("tags", """, r AS (SELECT seq_id, row_number() OVER (ORDER BY seq_id) AS k, count(*) OVER () AS n FROM tags) SELECT seq_id FROM r WHERE k % (n // 700 + 1) = 0"""),
)
def fil22(spark, sf):
    """Every k-th row by id, numbered in two phases: partition totals, then positions within a range partition."""
    from ..operators.intervals import running_total

    tags = v.tags(spark, sf).withColumn("one", F.lit(1))
    step = tags.count() // 700 + 1
    return running_total(tags, "one", [F.col("seq_id")], "k").filter(F.col("k") % step == 0).select("seq_id")


@query(
    "agg2_unify_tags",
    v.sql("sequences", f""", t AS (SELECT doc_id, seq, 1 + doc_id % 5 AS n FROM sequences), c AS (SELECT 'before' AS stage, doc_id, seq, n FROM t
  UNION ALL SELECT 'after', doc_id, CASE """ + " ".join(f"WHEN ends_with(seq, '{ADAPTOR[:k]}') THEN left(seq, len(seq) - {k})" for k in range(6, 0, -1)) + """ ELSE seq END, n FROM t)
  SELECT stage, seq, CAST(sum(n) AS BIGINT) AS n, min(doc_id) AS first_id FROM c GROUP BY ALL"""),
)
def agg2(spark, sf):
    """Sum of counts by whole sequence, before and after trimming; a sequence crosses the shuffle once for each stage."""
    tags = v.sequences(spark, sf).withColumn("n", 1 + F.col("doc_id") % 5)
    each = [tags.select(F.lit("before").alias("stage"), "doc_id", "seq", "n"), tags.select(F.lit("after").alias("stage"), "doc_id", sq.trim_tail(F.col("seq"), ADAPTOR, 6).alias("seq"), "n")]
    return each[0].unionByName(each[1]).groupBy("stage", "seq").agg(F.sum("n").alias("n"), F.min("doc_id").alias("first_id"))


_MATRIX = """, w AS (SELECT h.target_id, t.sample, CAST(t.n AS DOUBLE) / c.k AS x FROM hits h JOIN tags t ON t.seq_id = h.seq_id JOIN (SELECT seq_id, count(*) AS k FROM hits GROUP BY 1) c ON c.seq_id = h.seq_id)"""


def _weighted(spark, sf):
    hits = v.hits(spark, sf)
    k = hits.groupBy("seq_id").agg(F.count("*").alias("k"))
    return hits.join(k, "seq_id").join(v.tags(spark, sf), "seq_id").withColumn("x", F.col("n").cast("double") / F.col("k"))


@query(
    "agg7_tag_target_matrix",
    v.sql("hits tags", _MATRIX + """, t AS (SELECT unnest(range(60)) AS target_id), l AS (SELECT target_id, 200 + target_id * 37 % 400 AS len, avg(200 + target_id * 37 % 400) OVER () AS mean FROM t)
  SELECT l.target_id, """ + ", ".join(f"round(coalesce(sum(x) FILTER (sample = '{s}'), 0), 6) AS {s.lower()}" for s in "FOP") + ", "
    + ", ".join(f"round(coalesce(sum(x) FILTER (sample = '{s}'), 0) * mean / len, 5) AS {s.lower()}_by_length" for s in "FOP") + " FROM l LEFT JOIN w ON w.target_id = l.target_id GROUP BY l.target_id, len, mean"),
)
def agg7(spark, sf):
    """Sum of counts over hits for target and sample, as such and scaled to the mean target length; targets without hits keep a zero row."""
    wide = _weighted(spark, sf).groupBy("target_id").pivot("sample", ["F", "O", "P"]).agg(F.sum("x"))
    targets = spark.range(60).select(F.col("id").alias("target_id"), (200 + F.col("id") * 37 % 400).alias("len"))
    every = targets.join(F.broadcast(targets.agg(F.avg("len").alias("mean")))).join(wide, "target_id", "left")
    sums = [F.coalesce(s, F.lit(0.0)) for s in "FOP"]
    plain = [F.round(x, 6).alias(s) for x, s in zip(sums, "fop", strict=True)]
    return every.select("target_id", *plain, *[F.round(x * F.col("mean") / F.col("len"), 5).alias(f"{s}_by_length") for x, s in zip(sums, "fop", strict=True)])


def _by_strand(stranded: bool) -> str:
    return v.sql("reads regions", f"""SELECT g.region_id, round(coalesce(sum(r.weight) FILTER (role = 'fg'), 0), 6) AS fg, round(coalesce(sum(r.weight) FILTER (role = 'bg'), 0), 6) AS bg
  FROM regions g LEFT JOIN reads r ON r.chrom = g.chrom {"AND r.strand = g.strand" if stranded else ""} AND r.start < g."end" AND g.start < r."end" GROUP BY 1""")


def region_counts(reads, regions, stranded: bool):
    """Weights of the reads of each role over each region, regions without any as zeros."""
    from ..operators.intervals import region_sums

    of = {role: F.when(F.col("role") == role, F.col("weight")).otherwise(0.0) for role in ("fg", "bg")}
    sums = region_sums(reads, regions, "region_id", ["chrom", "strand"] if stranded else ["chrom"], of)
    return sums.select("region_id", *[F.round(s, 6).alias(s) for s in of])


@query("agg8_region_sample_counts", _by_strand(True))
def agg8(spark, sf):
    return region_counts(v.reads(spark, sf), v.regions(spark, sf), stranded=True)


@query("agg8_unstranded_counts", _by_strand(False))
def agg8_unstranded(spark, sf):
    return region_counts(v.reads(spark, sf), v.regions(spark, sf), stranded=False)


@query(
    "agg9_best_stratum",
    v.sql("hits", """, k AS (SELECT seq_id, CASE WHEN target_id < 25 THEN 'genome' ELSE 'other' END AS src, err, CASE WHEN count(*) > 3 THEN -1 ELSE count(*) END AS n FROM hits GROUP BY ALL),
  b AS (SELECT seq_id, min(err) AS err FROM k GROUP BY 1), m AS (SELECT k.seq_id, k.err, max(k.n) AS n_hits, min(k.n) AS low FROM k JOIN b ON b.seq_id = k.seq_id AND b.err = k.err GROUP BY ALL)
  SELECT seq_id, err, n_hits FROM m WHERE low > 0 AND n_hits <= 2"""),
)
def agg9(spark, sf):
    """The least error of each tag over all sources, and there the largest hit count; over-mapped tags leave."""
    source = F.when(F.col("target_id") < 25, "genome").otherwise("other")
    counts = v.hits(spark, sf).groupBy("seq_id", source.alias("source"), "err").agg(F.count("*").alias("k"))
    counts = counts.withColumn("n", F.when(F.col("k") > 3, -1).otherwise(F.col("k")))
    by_err = counts.groupBy("seq_id", "err").agg(F.max("n").alias("n_hits"), F.min("n").alias("low"))
    best = by_err.groupBy("seq_id").agg(F.min(F.struct("err", "n_hits", "low")).alias("b"))
    return best.filter("b.low > 0 and b.n_hits <= 2").select("seq_id", "b.err", "b.n_hits")


@query(
    "agg10_annotation_categories",
    v.sql("hits tags", """, k AS (SELECT *, count(*) OVER (PARTITION BY seq_id) AS hits FROM hits),
  a AS (SELECT seq_id, min(struct_pack(e := err, p := CASE WHEN target_id < 10 THEN 0 WHEN target_id < 25 THEN 1 ELSE 9 END, m := CASE WHEN strand = '+' THEN 0 ELSE 1 END)) AS b, max(hits) AS hits, bool_or(target_id >= 40) AS masked FROM k GROUP BY 1)
  SELECT t.sample, CASE WHEN b IS NULL THEN 'unknown_unmapped' WHEN b.p < 9 THEN ['gene', 'repeat'][b.p + 1] || CASE WHEN b.m = 0 THEN '+' ELSE '-' END WHEN hits > 6 THEN 'unknown_overmapped'
    WHEN masked THEN 'unknown_repeat' ELSE 'unknown_non-repeat' END AS category, CAST(sum(t.n) AS BIGINT) AS n FROM tags t LEFT JOIN a ON a.seq_id = t.seq_id GROUP BY ALL"""),
)
def agg10(spark, sf):
    """Family of highest priority at a tag's best error, + before -, by sample; only tags of no family are unknown: unmapped, with more than six hits, in a repeat (targets from 40 on), or else."""
    family = F.when(F.col("target_id") < 10, 0).when(F.col("target_id") < 25, 1).otherwise(9)
    best = v.hits(spark, sf).groupBy("seq_id").agg(
        F.min(F.struct("err", family.alias("p"), F.when(F.col("strand") == "+", 0).otherwise(1).alias("m"))).alias("b"), F.count("*").alias("hits"), F.bool_or(F.col("target_id") >= 40).alias("masked")
    )
    named = F.concat(F.when(F.col("b.p") == 0, "gene").otherwise("repeat"), F.when(F.col("b.m") == 0, "+").otherwise("-"))
    name = F.when(F.col("b.p") < 9, named).when(F.col("hits") > 6, "unknown_overmapped").when(F.col("masked"), "unknown_repeat").otherwise("unknown_non-repeat")
    joined = v.tags(spark, sf).join(best.select("seq_id", name.alias("name")), "seq_id", "left")
    return joined.groupBy("sample", F.coalesce("name", F.lit("unknown_unmapped")).alias("category")).agg(F.sum("n").alias("n"))


@query("agg11_mapped_totals", v.sql("hits tags", "SELECT sample, CAST(sum(n) AS BIGINT) AS mapped FROM tags WHERE seq_id IN (SELECT seq_id FROM hits) GROUP BY 1"))
def agg11(spark, sf):
    return v.tags(spark, sf).join(v.hits(spark, sf).select("seq_id"), "seq_id", "left_semi").groupBy("sample").agg(F.sum("n").alias("mapped"))


@query(
    "agg16_multiplicity_histogram",
    v.sql("hits tags", """, k AS (SELECT t.sample, t.n, count(h.seq_id) AS k FROM tags t LEFT JOIN hits h ON h.seq_id = t.seq_id GROUP BY t.seq_id, t.sample, t.n)
  SELECT sample, CASE WHEN k = 0 THEN '0' WHEN k = 1 THEN '1' WHEN k <= 5 THEN '<=5' WHEN k <= 10 THEN '<=10' WHEN k <= 50 THEN '<=50' WHEN k <= 100 THEN '<=100' ELSE 'many' END AS bin, CAST(sum(n) AS BIGINT) AS n FROM k GROUP BY ALL"""),
)
def agg16(spark, sf):
    counts = v.hits(spark, sf).groupBy("seq_id").agg(F.count("*").alias("k"))
    k = F.coalesce("k", F.lit(0))
    label = F.when(k == 0, "0").when(k == 1, "1").when(k <= 5, "<=5").when(k <= 10, "<=10").when(k <= 50, "<=50").when(k <= 100, "<=100").otherwise("many")
    return v.tags(spark, sf).join(counts, "seq_id", "left").groupBy("sample", label.alias("bin")).agg(F.sum("n").alias("n"))


#: Letters replaced in the alignments of ``aligned_reads``, by number of the hit.
_ALIGNED = """, m AS (SELECT read_id, read_id % 3 AS sample, 1 + read_id % 5 AS n, read_id % 7 AS k, seq AS q FROM fastq),
  al AS (SELECT *, CAST(n AS DOUBLE) / k AS w, CASE (read_id + j) % 4 WHEN 0 THEN substr(q, 1, 7) || 'A' || substr(q, 9) WHEN 1 THEN replace(q, 'N', 'C') WHEN 2 THEN substr(q, 1, 2) || translate(substr(q, 3, 9), 'AC', 'CA') || substr(q, 12) ELSE q END AS t
    FROM (SELECT *, unnest(range(k)) AS j FROM m WHERE k BETWEEN 1 AND 5)),
  p AS (SELECT read_id, j, sample, w, unnest(range(1, len(q) + 1)) AS cycle, q, t FROM al),
  e AS (SELECT sample, read_id, j, w, cycle, CASE WHEN substr(q, CAST(cycle AS INTEGER), 1) <> substr(t, CAST(cycle AS INTEGER), 1) THEN 1 ELSE 0 END AS bad FROM p),
  c AS (SELECT *, sum(bad) OVER (PARTITION BY read_id, j ORDER BY cycle) AS errors FROM e), s AS (SELECT sample, sum(n) AS total, sum(n) FILTER (k = 6) AS many, sum(n) FILTER (k = 0) AS none FROM m GROUP BY 1)"""


def aligned_reads(spark, sf):
    """``read_id, sample, n, k, q``: reads with their counts and numbers of hits: none for every seventh, too many (6) for another seventh, else one to five, which ``_hits`` lists with their targets."""
    k = F.col("read_id")
    return v.fastq(spark, sf).select("read_id", (k % 3).alias("sample"), (1 + k % 5).alias("n"), (k % 7).alias("k"), F.col("seq").alias("q"))


def _hits(reads):
    """``sample, n, k, q, t``: a row for each hit of :func:`aligned_reads`, with its target."""
    hits = reads.filter("k between 1 and 5").withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
    q, kind = F.col("q"), (F.col("read_id") + F.col("j")) % 4
    target = F.when(kind == 0, F.concat(F.substring(q, 1, 7), F.lit("A"), F.expr("substr(q, 9)"))).when(kind == 1, F.replace(q, F.lit("N"), F.lit("C")))
    target = target.when(kind == 2, F.concat(F.substring(q, 1, 2), F.translate(F.substring(q, 3, 9), "AC", "CA"), F.expr("substr(q, 12)"))).otherwise(q)
    return hits.select("sample", "n", "k", "q", target.alias("t"))


#: Places of a batch's table of sums up to which it is summed whole.
DENSE = 4_000_000


def cycles(hits):
    """``sample, cycle, bad, errors, w``: the weight (n/hits) of all hits (``sample, n, k, q, t``) of a sample that differ (``bad``) at a cycle or not and have had so many differences up to there.

    A target that ends before the read differs there. Each batch of hits is one table of letters, whose rows' differences are summed along the cycles, and returns only its own sums: a row a sample,
    cycle and number, not one a letter. Sums of n go by k, whole numbers, so they are the same however the batches fall.
    """

    def run(batches):
        for hits in batches:
            if not len(hits):
                continue
            q, t = (hits[c].to_numpy("U") for c in "qt")
            size = np.char.str_len(q)
            wide = max(1, int(size.max()))
            letters = lambda x: np.ascontiguousarray(x.astype(f"U{wide}")).view("u4").reshape(len(x), wide)
            bad = (letters(q) != letters(t)).astype("i4")
            there = np.arange(wide) < size[:, None]
            kinds, kind = np.unique(hits[["sample", "k"]].to_numpy("i8"), axis=0, return_inverse=True)
            at = (((kind.reshape(-1, 1) * wide + np.arange(wide)) * 2 + bad) * (wide + 1) + bad.cumsum(1))[there]
            n = np.broadcast_to(hits["n"].to_numpy("f8")[:, None], there.shape)[there]
            if len(kinds) * wide * 2 * (wide + 1) <= DENSE:
                sums = np.bincount(at, n)
                found = np.flatnonzero(sums)
                sums = sums[found]
            else:  # long reads: only the places met
                found, place = np.unique(at, return_inverse=True)
                sums = np.bincount(place, n)
            rest, errors = np.divmod(found, wide + 1)
            rest, differs = np.divmod(rest, 2)
            kind, cycle = np.divmod(rest, wide)
            sample, k = kinds[kind].T
            yield pd.DataFrame({"sample": sample, "cycle": cycle + 1, "bad": differs, "errors": errors, "k": k, "n": sums.astype("i8")})

    counts = hits.filter("q is not null").mapInPandas(run, "sample long, cycle long, bad int, errors int, k long, n long")
    whole = counts.groupBy("sample", "cycle", "bad", "errors", "k").agg(F.sum("n").alias("n"))
    return whole.groupBy("sample", "cycle", "bad", "errors").agg(F.sum(F.col("n").cast("double") / F.col("k")).alias("w"))


@query("agg17_error_profile", v.sql("fastq", _ALIGNED + " SELECT sample, cycle, round(sum(w), 6) AS total, round(100.0 * sum(w * bad) / sum(w), 6) AS percent FROM c GROUP BY ALL"))
def agg17(spark, sf):
    """Share of differing letters by sample and cycle, hits weighted by their read's count over its hits."""
    out = cycles(_hits(aligned_reads(spark, sf))).groupBy("sample", "cycle").agg(F.sum("w").alias("t"), F.sum(F.col("w") * F.col("bad")).alias("b"))
    return out.select("sample", "cycle", F.round("t", 6).alias("total"), F.round(100.0 * F.col("b") / F.col("t"), 6).alias("percent"))


@query(
    "agg17_aligned_by_errors",
    v.sql("fastq", _ALIGNED + f""", r AS (SELECT sample, cycle, CAST(errors AS VARCHAR) AS errors, sum(w) AS w FROM c GROUP BY ALL UNION ALL SELECT sample, cycle, 'ambiguous', coalesce(many, 0) FROM s, (SELECT unnest(range(1, {v.READ + 1})) AS cycle)
    UNION ALL SELECT sample, cycle, 'unmapped', coalesce(none, 0) FROM s, (SELECT unnest(range(1, {v.READ + 1})) AS cycle))
  SELECT r.sample, cycle, errors, round(100.0 * w / total, 9) AS percent FROM r JOIN s ON s.sample = r.sample"""),
)
def agg17_aligned(spark, sf):
    """By sample and cycle the percentage of all its reads that have had so many differences up to there, that have too many hits, and that have none; the last two are the same for every cycle."""
    reads = aligned_reads(spark, sf)
    n = lambda k: F.coalesce(F.sum(F.when(F.col("k") == k, F.col("n"))), F.lit(0)).cast("double")
    totals = reads.groupBy("sample").agg(F.sum("n").alias("total"), n(6).alias("many"), n(0).alias("none"))
    known = cycles(_hits(reads)).groupBy("sample", "cycle", F.col("errors").cast("string").alias("errors")).agg(F.sum("w").alias("w"))
    rest = totals.select("sample", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(v.READ).cast("long"))).alias("cycle"), F.explode(F.expr("map('ambiguous', many, 'unmapped', none)")).alias("errors", "w"))
    every = known.unionByName(rest).join(totals.select("sample", "total"), "sample")
    return every.select("sample", "cycle", "errors", F.round(100.0 * F.col("w") / F.col("total"), 9).alias("percent"))


@query(
    "agg18_length_histogram",
    v.sql("fastq tailed", f""", c AS (SELECT 'before' AS stage, len(seq) AS length FROM tailed UNION ALL SELECT 'after', len({_TAIL}) FROM tailed), h AS (SELECT stage, length, count(*) AS n FROM c GROUP BY ALL)
  SELECT stage, length, n, CAST(sum(n) OVER (PARTITION BY stage ORDER BY length DESC) AS BIGINT) AS at_least FROM h"""),
)
def agg18(spark, sf):
    """Read lengths before and after trimming, and how many are at least as long; the window runs over one row a length."""
    reads = v.tailed(spark, sf)
    both = reads.select(F.lit("before").alias("stage"), "seq").unionByName(reads.select(F.lit("after").alias("stage"), sq.trim_tail(F.col("seq"), ADAPTOR, 6).alias("seq")))
    counts = both.groupBy("stage", F.length("seq").cast("long").alias("length")).agg(F.count("*").alias("n"))
    return counts.withColumn("at_least", F.sum("n").over(Window.partitionBy("stage").orderBy(F.desc("length"))))


CANDIDATES = {"one": "ACTGACTGACTGACTGACTG", "two": "TACGTTACGTTACGTTACGT", "three": ADAPTOR + "ACGT"}
PREFIXES = (14, 16, 18, 20)


#: Reads that the vote samples, and the step of the grid of totals.
VOTE, STEP = 3000, 100


@query(
    "agg19_adaptor_vote",
    v.sql("fastq tailed", f""", z AS (SELECT count(*) AS all_reads, least(1.0, {VOTE}.0 / count(*)) AS share FROM tailed),
  s AS (SELECT seq FROM (SELECT seq, list_reduce([instr('0123456789abcdef', c) - 1 FOR c IN string_split(substr(md5(CAST(read_id AS VARCHAR)), 1, 6), '')], lambda a, b: a * 16 + b) AS h FROM tailed), z WHERE share >= 0.9 OR h < share * 16777216),
  a AS (SELECT * FROM (VALUES """ + ", ".join(f"('{k}', '{x}')" for k, x in CANDIDATES.items()) + f""") t(name, adaptor)),
  m AS (SELECT name, k, count(*) FILTER (contains(seq, left(adaptor, CAST(k AS INTEGER)))) AS n FROM s, a, (SELECT unnest([14, 16, 18, 20]) AS k) GROUP BY ALL),
  v AS (SELECT name, avg(n) AS matches, max(n) AS top, max(k) FILTER (TRUE) AS longest FROM m GROUP BY 1), w AS (SELECT * FROM v ORDER BY matches DESC, name LIMIT 1),
  l AS (SELECT w.name, greatest(14, coalesce(min(m.k) - 2, max(longest))) AS k FROM w LEFT JOIN m ON m.name = w.name AND m.n < 0.8 * w.top GROUP BY w.name),
  b AS (SELECT l.name, l.k, m.n AS m, (SELECT count(*) FROM s) AS n, (SELECT all_reads FROM z) AS total FROM l JOIN m ON m.name = l.name AND m.k = l.k),
  g AS (SELECT b.*, unnest(range(m, total - n + m, {STEP})) AS x FROM b), p AS (SELECT x, CASE WHEN m > 0 THEN m * ln(x / total) ELSE 0 END + CASE WHEN n > m THEN (n - m) * ln(1 - x / total) ELSE 0 END AS ll FROM g),
  q AS (SELECT x, exp(ll - (SELECT max(ll) FROM p)) AS f FROM p), c AS (SELECT x, sum(f) OVER (ORDER BY x) / sum(f) OVER () AS cum FROM q),
  e AS (SELECT min(x) FILTER (cum >= 0.025) AS low, min(x) FILTER (cum >= 0.975) AS high FROM c)
  SELECT v.name, round(matches, 6) AS matches, b.name IS NOT NULL AS chosen, left(a.adaptor, CAST(b.k AS INTEGER)) AS subword, b.m, CASE WHEN b.name IS NOT NULL THEN low END AS low, CASE WHEN b.name IS NOT NULL THEN high END AS high
  FROM v JOIN a ON a.name = v.name LEFT JOIN b ON b.name = v.name, e"""),
)
def agg19(spark, sf):
    """Vote of a sample of reads for an adaptor: mean number of reads with a prefix of each candidate, over the prefix lengths.

    The best candidate's subword is the longest prefix before the matches fall below four fifths of the most; of its matches in all reads, given those in the sample, the row
    has the bounds of the middle 95 % of the posterior, a binomial likelihood on a grid of totals. The grid is a table, and its sums run in two phases.
    """
    tailed = v.tailed(spark, sf)
    total = tailed.count()
    counts = [F.count_if(F.col("seq").contains(x[:k])).alias(f"{name}_{k}") for name, x in CANDIDATES.items() for k in PREFIXES]
    one = down_sample(tailed, VOTE, "read_id").agg(F.count("*").alias("reads"), *counts).first()
    found = {name: [one[f"{name}_{k}"] for k in PREFIXES] for name in CANDIDATES}
    best = min(found, key=lambda name: (-sum(found[name]), name))
    fallen = [k for k, n in enumerate(found[best]) if n < 0.8 * max(found[best])]
    at = max(0, fallen[0] - 1) if fallen else len(PREFIXES) - 1
    low, high = posterior_bounds(spark, total, one["reads"], found[best][at])
    rows = [(name, round(sum(n) / len(n), 6), name == best, *((CANDIDATES[name][: PREFIXES[at]], n[at], low, high) if name == best else (None,) * 4)) for name, n in found.items()]
    return spark.createDataFrame(rows, "name string, matches double, chosen boolean, subword string, m long, low long, high long")


def posterior_bounds(spark, total: int, n: int, m: int, step: int = STEP, within: float = 0.95) -> tuple[int | None, int | None]:
    """Bounds of the middle ``within`` of the posterior of the matches in ``total`` reads when ``m`` of ``n`` sampled ones match, on a grid of ``step`` from m to what the rest allows."""
    from ..operators.intervals import running_total

    if total - n <= 0:
        return None, None
    x = F.col("id")
    ll = (m * F.log(x / total) if m else F.lit(0.0)) + ((n - m) * F.log(1 - x / total) if n > m else F.lit(0.0))
    grid = spark.range(m, total - n + m, step).select(x.alias("x"), ll.alias("ll"))
    top = grid.agg(F.max("ll")).first()[0]
    sums = running_total(grid.select("x", F.exp(F.col("ll") - top).alias("f")), "f", [F.col("x")], "cum")
    whole = sums.agg(F.max("cum").alias("whole"))
    edge = (1 - within) / 2
    ends = [F.min(F.when(F.col("cum") >= share * F.col("whole"), F.col("x"))) for share in (edge, 1 - edge)]
    return tuple(sums.join(F.broadcast(whole)).agg(*ends).first())


CHAIN = tr.Chain(five=v.FIVE, three=ADAPTOR)


def _known(side: int) -> str:
    """SQL rows of the full-length variants of an adaptor, and of those of its parts by length."""
    full = ", ".join(f"('{x}', {d})" for x, d in CHAIN.full[side].items())
    part = ", ".join(f"({k}, '{x}', {d})" for k, known in CHAIN.part[side].items() for x, d in known.items())
    return f"full{side}(x, d) AS (VALUES {full}), part{side}(k, x, d) AS (VALUES {part})"


def _steps(side: int, source: str) -> str:
    """SQL of the inexact and the exact step of a side: ``e{side}`` has the part's length, kind and changes for the tags that need it."""
    adaptor = CHAIN.five if side == 5 else CHAIN.three
    own = "left(z, k)" if side == 5 else "right(z, k)"
    exact = f"right('{adaptor}', k)" if side == 5 else f"left('{adaptor}', k)"
    return f""", i{side} AS (SELECT seq, max(struct_pack(k := p.k, d := p.d)) AS i FROM (SELECT seq, z, unnest(range({CHAIN.one}, {len(adaptor)}))::INTEGER AS k FROM {source} WHERE f{side} IS NULL) JOIN part{side} p USING (k) WHERE len(z) >= k AND {own} = p.x GROUP BY 1),
  x{side} AS (SELECT seq, max(k) AS k FROM (SELECT seq, z, unnest(range(1, {CHAIN.one}))::INTEGER AS k FROM {source} WHERE f{side} IS NULL AND seq NOT IN (SELECT seq FROM i{side})) WHERE len(z) >= k AND {own} = {exact} GROUP BY 1)"""


_L5, _L3 = len(CHAIN.five), len(CHAIN.three)
_CHAIN = f""", {_known(5)}, {_known(3)}, u AS (SELECT seq, min(id) AS id, CAST(sum(n) AS BIGINT) AS n FROM tagged GROUP BY 1),
  a5 AS (SELECT seq, arg_min(struct_pack(i := i, k := k, d := d), struct_pack(i := -i, k := k)) AS f FROM (SELECT seq, i, k::INTEGER AS k, substr(seq, i::INTEGER + 1, k::INTEGER) AS t FROM (SELECT seq, unnest(range(0, len(seq) - {_L5} + 2)) AS i FROM u WHERE len(seq) >= {_L5 - 1}), (SELECT unnest([{_L5 - 1}, {_L5}, {_L5 + 1}]) AS k)) JOIN full5 ON t = x WHERE len(t) = k GROUP BY 1),
  s1 AS (SELECT u.*, f AS f5, CASE WHEN f IS NULL THEN seq ELSE substr(seq, CAST(f.i + f.k + 1 AS INTEGER)) END AS y FROM u LEFT JOIN a5 USING (seq)),
  a3 AS (SELECT seq, arg_min(struct_pack(i := i, k := k, d := d), struct_pack(i := i, k := k)) AS f FROM (SELECT seq, i, k::INTEGER AS k, substr(y, i::INTEGER + 1, k::INTEGER) AS t FROM (SELECT seq, y, unnest(range(0, len(y) - {_L3} + 2)) AS i FROM s1 WHERE len(y) >= {_L3 - 1}), (SELECT unnest([{_L3 - 1}, {_L3}, {_L3 + 1}]) AS k)) JOIN full3 ON t = x WHERE len(t) = k GROUP BY 1),
  s2 AS (SELECT s1.*, f AS f3, CASE WHEN f IS NULL THEN y ELSE left(y, CAST(f.i AS INTEGER)) END AS z FROM s1 LEFT JOIN a3 USING (seq)){_steps(5, "s2")},
  s3 AS (SELECT s2.* REPLACE (substr(z, CAST(coalesce(i.k, k, 0) + 1 AS INTEGER)) AS z), CASE WHEN f5 IS NOT NULL THEN struct_pack(a := CAST(f5.i + 1 AS BIGINT), b := CAST(f5.i + f5.k AS BIGINT), kind := 'full', d := CAST(f5.d AS INTEGER)) WHEN i IS NOT NULL THEN struct_pack(a := 1, b := i.k, kind := 'inexact', d := i.d)
    WHEN k IS NOT NULL THEN struct_pack(a := 1, b := k, kind := 'exact', d := 0) END AS r5 FROM s2 LEFT JOIN i5 USING (seq) LEFT JOIN x5 USING (seq)){_steps(3, "s3")},
  s4 AS (SELECT s3.* REPLACE (left(z, CAST(len(z) - coalesce(i.k, k, 0) AS INTEGER)) AS z), CASE WHEN f3 IS NOT NULL THEN struct_pack(a := CAST(len(seq) - len(y) + f3.i + 1 AS BIGINT), b := CAST(len(seq) - len(y) + f3.i + f3.k AS BIGINT), kind := 'full', d := CAST(f3.d AS INTEGER))
    WHEN i IS NOT NULL THEN struct_pack(a := len(seq) - i.k + 1, b := len(seq), kind := 'inexact', d := i.d) WHEN k IS NOT NULL THEN struct_pack(a := len(seq) - k + 1, b := len(seq), kind := 'exact', d := 0) END AS r3 FROM s3 LEFT JOIN i3 USING (seq) LEFT JOIN x3 USING (seq)),
  c AS (SELECT seq, id, n, z AS trimmed, CAST(r5.a AS INTEGER) AS five_from, CAST(r5.b AS INTEGER) AS five_to, r5.kind AS five_kind, r5.d AS five_changes, CAST(r3.a AS INTEGER) AS three_from, CAST(r3.b AS INTEGER) AS three_to, r3.kind AS three_kind, r3.d AS three_changes,
    CASE WHEN coalesce(r5.b - r5.a + 1, 0) < 1 THEN 'five_short' WHEN coalesce(r3.b - r3.a + 1, 0) < 3 THEN 'three_short' ELSE 'cleaned' END AS fate FROM s4)"""
_SUMS = [("input", "sum(n)"), ("unique_input", "count(*)")] + [(f"{s}_{k}", f"sum(n) FILTER ({s}_kind = '{k}')") for s in ("five", "three") for k in ("full", "inexact", "exact")]
_SUMS += [(f"{s}_any", f"sum(n) FILTER ({s}_kind IS NOT NULL)") for s in ("five", "three")] + [(f, f"sum(n) FILTER (fate = '{f}')") for f in ("five_short", "three_short")]


def _trimmed(spark, sf):
    return tr.trimmed_tags(v.tagged(spark, sf), CHAIN, least_five=1, least_three=3)


@query("fil6_adaptor_chain", v.sql("fastq tagged", _CHAIN + " SELECT * FROM c"))
def fil6_chain(spark, sf):
    """Every distinct tag through all steps on both sides: full, else inexact, else exact, with places, kinds and changes."""
    return _trimmed(spark, sf)


@query(
    "agg20_cleaned_tags",
    v.sql("fastq tagged", _CHAIN + """, m AS (SELECT trimmed AS seq, min(id) AS id, CAST(sum(n) AS BIGINT) AS n FROM c WHERE fate = 'cleaned' GROUP BY 1), d AS (SELECT seq, [substr(seq, CAST(i AS INTEGER), 2) FOR i IN range(1, len(seq))] AS di FROM m),
  w AS (SELECT seq, x, count(*) AS n FROM (SELECT seq, unnest(di) AS x FROM d) GROUP BY ALL), e AS (SELECT seq, -sum(n / t * ln(n / t) / ln(16)) / 0.9770337 AS h FROM (SELECT *, sum(n) OVER (PARTITION BY seq) AS t FROM w) GROUP BY 1)
  SELECT m.*, CASE WHEN len(m.seq) < 14 THEN 1 WHEN len(m.seq) - len(replace(m.seq, 'N', '')) > 2 THEN 2 WHEN round(coalesce(h, 0), 9) < 0.5 THEN 3 ELSE 0 END AS code FROM m LEFT JOIN e ON e.seq = m.seq"""),
)
def agg20_cleaned(spark, sf):
    """What is left of the tags, equal ones as one, with the filter that each meets."""
    return tr.cleaned_tags(_trimmed(spark, sf))


@query(
    "agg20_trimming_summary",
    v.sql("fastq tagged", _CHAIN + """, m AS (SELECT trimmed AS seq, sum(n) AS n FROM c WHERE fate = 'cleaned' GROUP BY 1), d AS (SELECT seq, [substr(seq, CAST(i AS INTEGER), 2) FOR i IN range(1, len(seq))] AS di FROM m),
  w AS (SELECT seq, x, count(*) AS n FROM (SELECT seq, unnest(di) AS x FROM d) GROUP BY ALL), e AS (SELECT seq, -sum(n / t * ln(n / t) / ln(16)) / 0.9770337 AS h FROM (SELECT *, sum(n) OVER (PARTITION BY seq) AS t FROM w) GROUP BY 1),
  k AS (SELECT m.n, CASE WHEN len(m.seq) < 14 THEN 1 WHEN len(m.seq) - len(replace(m.seq, 'N', '')) > 2 THEN 2 WHEN round(coalesce(h, 0), 9) < 0.5 THEN 3 ELSE 0 END AS code FROM m LEFT JOIN e ON e.seq = m.seq),
  r AS (""" + " UNION ALL ".join(f"SELECT '{name}' AS counter, {sum_} AS n FROM c" for name, sum_ in _SUMS) + " UNION ALL SELECT 'unique_output', (SELECT count(*) FROM m) + (SELECT count(*) FROM c WHERE fate <> 'cleaned')"
    + "".join(f" UNION ALL SELECT '{name}', sum(n) FROM k WHERE code = {code}" for name, code in (("too_short", 1), ("too_many_n", 2), ("low_entropy", 3), ("passed", 0)))
    + ") SELECT counter, CAST(coalesce(n, 0) AS BIGINT) AS n, round(100.0 * coalesce(n, 0) / (SELECT sum(n) FROM u), 6) AS percent FROM r"),
)
def agg20(spark, sf):
    """The chain's report: counters of both sides, of alignments that are too short, of filters and of what passed."""
    return tr.trimming_report(_trimmed(spark, sf))


@query(
    "joi18_hit_resolution",
    v.sql("hits tags", """, b AS (SELECT seq_id, min(err) AS err FROM hits GROUP BY 1) SELECT h.seq_id, h.target_id, h.start, h.err, t.sample, t.n FROM hits h JOIN b ON b.seq_id = h.seq_id AND b.err = h.err JOIN tags t ON t.seq_id = h.seq_id WHERE t.n > 1"""),
)
def joi18(spark, sf):
    hits = v.hits(spark, sf)
    best = hits.groupBy("seq_id").agg(F.min("err").alias("err"))
    return hits.join(best, ["seq_id", "err"]).join(v.tags(spark, sf).filter("n > 1"), "seq_id").select("seq_id", "target_id", "start", "err", "sample", "n")


@query(
    "joi20_sample_subset",
    v.sql("hits tags", """SELECT 'kept' AS what, count(*) AS n FROM hits WHERE seq_id IN (SELECT seq_id FROM tags WHERE sample = 'F')
  UNION ALL SELECT 'unmapped', CAST(coalesce(sum(n), 0) AS BIGINT) FROM tags WHERE sample = 'F' AND seq_id NOT IN (SELECT seq_id FROM hits)"""),
)
def joi20(spark, sf):
    hits, own = v.hits(spark, sf), v.tags(spark, sf).filter("sample = 'F'")
    kept = hits.join(own, "seq_id", "left_semi").agg(F.count("*").alias("n")).select(F.lit("kept").alias("what"), "n")
    lost = own.join(hits.select("seq_id"), "seq_id", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return kept.unionByName(lost.select(F.lit("unmapped").alias("what"), "n"))


@query(
    "joi17_id_list_semi_anti",
    v.sql("tags hits", """SELECT seq_id, CASE WHEN seq_id IN (SELECT seq_id FROM hits WHERE target_id = 7) THEN 'selected' ELSE 'missing' END AS how FROM tags"""),
)
def joi17(spark, sf):
    tags, chosen = v.tags(spark, sf), v.hits(spark, sf).filter("target_id = 7").select("seq_id")
    a = tags.join(chosen, "seq_id", "left_semi").select("seq_id", F.lit("selected").alias("how"))
    return a.unionByName(tags.join(chosen, "seq_id", "left_anti").select("seq_id", F.lit("missing").alias("how")))


@query("win11_top_tags", v.sql("sequences", "SELECT seq, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, seq) AS rank FROM sequences GROUP BY 1 ORDER BY rank LIMIT 200"))
def win11(spark, sf):
    best = v.sequences(spark, sf).groupBy("seq").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "seq").limit(200)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "seq")).cast("long"))


@query(
    "fun4_alignment_descriptor",
    v.sql("fastq", """, r AS (SELECT read_id, seq, substr(seq, 1, 3) || '-' || substr(seq, 5) AS q, substr(translate(seq, 'N', 'A'), 1, 7) || '-' || substr(translate(seq, 'N', 'A'), 9) AS t FROM fastq WHERE len(seq) >= 9),
  p AS (SELECT read_id, unnest(range(1, len(q) + 1)) AS i, q, t FROM r), m AS (SELECT read_id, i, substr(q, CAST(i AS INTEGER), 1) AS a, substr(t, CAST(i AS INTEGER), 1) AS b FROM p),
  g AS (SELECT *, sum(CASE WHEN a = b THEN 0 ELSE 1 END) OVER (PARTITION BY read_id ORDER BY i) AS k FROM m),
  s AS (SELECT read_id, k, max(CASE WHEN a <> b THEN CASE WHEN a = '-' THEN 'D' || b WHEN b = '-' THEN 'I' || a ELSE a END END) AS other, count(*) FILTER (a = b) AS run FROM g GROUP BY ALL),
  d AS (SELECT read_id, string_agg(concat_ws(' ', other, CASE WHEN run > 0 THEN run || 'M' END), ' ' ORDER BY k) AS text FROM s GROUP BY 1)
  SELECT r.read_id, d.text, replace(r.q, '-', '') AS query FROM r JOIN d ON d.read_id = r.read_id"""),
)
def fun4(spark, sf):
    """A read against its target with a gap in each: the description, and the read put back from it."""
    target = F.translate("seq", "N", "A")
    both = v.fastq(spark, sf).filter("length(seq) >= 9").select(
        "read_id", F.concat(F.substring("seq", 1, 3), F.lit("-"), F.expr("substr(seq, 5)")).alias("q"), F.concat(F.substring(target, 1, 7), F.lit("-"), F.substr(target, F.lit(9))).alias("t")
    )
    text = both.withColumn("text", sq.describe(F.col("q"), F.col("t")))
    return text.select("read_id", "text", sq.restore(F.replace("t", F.lit("-"), F.lit("")), F.col("text")).alias("query"))


@query("fun5_solexa_scores", v.sql("fastq", "SELECT read_id, [CAST(ascii(x) - 64 AS INTEGER) FOR x IN string_split(qual, '') IF x <> ''] AS scores FROM fastq"))
def fun5(spark, sf):
    return v.fastq(spark, sf).select("read_id", F.transform(sq.ascii_codes(F.col("qual")), lambda c: c - 64).alias("scores"))


@query("fun6_reverse_complement", v.sql("fastq", "SELECT read_id, reverse(translate(seq, 'ACGTRYKMBVDHN', 'TGCAYRMKVBHDN')) AS rc FROM fastq"))
def fun6(spark, sf):
    return v.fastq(spark, sf).select("read_id", sq.reverse_complement(F.col("seq")).alias("rc"))


@query("fun7_normalise_sequence", "SELECT doc_id, regexp_replace(translate(text, 'abcdefghijklmnopqrstuvwxyzU', 'ABCDEFGHIJKLMNOPQRSTTVWXYZT'), '[^ACGT]', 'N', 'g') AS seq FROM documents")
def fun7(spark, sf):
    return v.read(spark, sf, "documents").select("doc_id", sq.normalise(F.col("text")).alias("seq"))


@query(
    "agg21_base_composition",
    v.sql("sequences", """, c AS (SELECT sum(len(seq) - len(replace(replace(seq, 'A', ''), 'T', ''))) AS n_at, sum(len(seq) - len(replace(replace(seq, 'C', ''), 'G', ''))) AS n_gc FROM sequences)
  SELECT round(n_at / (n_at + n_gc) / 2, 3) AS at_half, round(0.5 - round(n_at / (n_at + n_gc) / 2, 3), 3) AS gc_half FROM c"""),
)
def agg21(spark, sf):
    """Strand-symmetric shares of A or T and of C or G, to three digits, summing to a half."""
    count = lambda letters: F.sum(F.length("seq") - F.length(F.translate("seq", letters, "")))
    c = v.sequences(spark, sf).agg(count("AT").alias("at"), count("CG").alias("gc"))
    at = F.round(F.col("at") / (F.col("at") + F.col("gc")) / 2, 3)
    return c.select(at.alias("at_half"), F.round(0.5 - at, 3).alias("gc_half"))
