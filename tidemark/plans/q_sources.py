"""Round trips of the text formats: a table is written in the format and read back, so the rows are those of the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sources as s
from . import views as v
from .registry import query


def _text(df, spark, name, *columns):
    path = s.scratch(spark, name)
    df.select(F.concat(*columns).alias("value")).write.text(path)
    return path


T, NL, SP = F.lit, "\n", " "


@query("src1_fastq_scan", v.sql("fastq", "SELECT CAST(read_id AS VARCHAR) AS read_id, seq, qual FROM fastq WHERE len(seq) = len(qual)"))
def src1(spark, sf):
    path = s.scratch(spark, "fastq")
    s.write_fastq(v.fastq(spark, sf), path)
    return s.read_fastq(spark, path)


@query("src2_fasta_scan", v.sql("sequences", "SELECT 't' || doc_id AS tag_id, 1 + doc_id % 9 AS n, seq FROM sequences"))
def src2(spark, sf):
    two = F.concat(F.substring("seq", 1, 60), F.lit("\n"), F.expr("substr(seq, 61)"))
    return s.read_fasta(spark, _text(v.sequences(spark, sf), spark, "fasta", F.lit(">t"), F.col("doc_id").cast("string"), F.lit(" "), (1 + F.col("doc_id") % 9).cast("string"), F.lit("\n"), two))


#: Letters of a chunk, and of the next one's beginning that it has as well.
CHUNK, HALO = 1000, 15


@query(
    "src2_fasta_chunks",
    v.sql("sequences", f", c AS (SELECT doc_id, seq, unnest(range((len(seq) - 1) // {CHUNK} + 1)) AS chunk FROM sequences WHERE len(seq) > 0) SELECT 't' || doc_id AS tag_id, 1 + doc_id % 9 AS n, chunk, chunk * {CHUNK} AS origin, substr(seq, CAST(chunk * {CHUNK} + 1 AS INTEGER), {CHUNK + HALO}) AS seq FROM c"),
)
def src2_chunks(spark, sf):
    """Records of many lines, read line by line and put together in chunks, so that a chromosome is never one row."""
    lines = F.regexp_replace("seq", "(.{60})", "$1\n")
    path = _text(v.sequences(spark, sf), spark, "fasta", F.lit(">t"), F.col("doc_id").cast("string"), F.lit(" "), (1 + F.col("doc_id") % 9).cast("string"), F.lit("\n"), lines)
    return s.read_fasta_chunks(spark, path, CHUNK, HALO)


@query("src2_tag_table", v.sql("sequences", "SELECT CASE WHEN doc_id % 3 = 0 THEN seq ELSE 't' || doc_id END AS tag_id, CASE WHEN doc_id % 3 = 1 THEN 1 ELSE 1 + doc_id % 9 END AS n, seq FROM sequences WHERE seq IS NOT NULL"))
def src2_tab(spark, sf):
    """Counted sequences, named sequences, and named counted ones, in one file."""
    k, n = F.col("doc_id") % 3, (1 + F.col("doc_id") % 9).cast("string")
    id_ = F.concat(F.lit("t"), F.col("doc_id").cast("string"))
    line = F.when(k == 0, F.concat_ws("\t", "seq", n)).when(k == 1, F.concat_ws("\t", id_, "seq")).otherwise(F.concat_ws("\t", id_, "seq", n))
    return s.read_tag_table(spark, _text(v.sequences(spark, sf).filter("seq is not null"), spark, "tags", line))


@query(
    "src3_tag_import",
    v.sql("fastq", """, t AS (SELECT replace(seq, 'N', 'A') AS seq, 1 + read_id % 5 AS n FROM fastq WHERE seq <> ''), o AS (SELECT seq, CAST(sum(n) AS BIGINT) AS n FROM t GROUP BY 1 HAVING count(*) = 1)
  SELECT 'sq' || row_number() OVER (ORDER BY seq) AS tag_id, seq, n FROM o"""),
)
def src3(spark, sf):
    tags = v.fastq(spark, sf).filter("seq <> ''")
    return s.import_tags(spark, _text(tags, spark, "tags", F.lower(F.translate("seq", "NT", "AU")), F.lit("\t"), (1 + F.col("read_id") % 5).cast("string")))


@query("src4_bed_round_trip", v.sql("reads", """SELECT chrom, start, "end", CAST(event_id AS VARCHAR) AS id, weight, strand FROM reads"""))
def src4(spark, sf):
    path = s.scratch(spark, "bed")
    s.write_bed(v.reads(spark, sf).withColumn("id", F.col("event_id").cast("string")), path)
    return s.read_bed(spark, path)


@query("src5_repeat_scan", v.sql("regions", """SELECT chrom, start, "end", strand FROM regions"""))
def src5(spark, sf):
    line = F.concat_ws(" ", F.lit("  778 167 7 20"), "chrom", F.col("start") + 1, "end", F.lit("-23011390"), F.when(F.col("strand") == "+", "+").otherwise("C"), F.lit("HETRP_DM"))
    head = spark.range(1).select(F.lit("   SW  perc perc perc  query").alias("value"))
    path = s.scratch(spark, "repeats")
    v.regions(spark, sf).select(line.alias("value")).unionByName(head).write.text(path)
    return s.read_repeats(spark, path)


@query("src6_gene_scan", v.sql("regions", """SELECT chrom, start, "end", 'n' || region_id AS name, strand, region_id AS id FROM regions"""))
def src6(spark, sf):
    sign = F.when(F.col("strand") == "+", "1").otherwise("-1")
    return s.read_genes(spark, _text(v.regions(spark, sf), spark, "genes", F.concat_ws("\t", "chrom", "start", "end", F.concat(F.lit("n"), "region_id"), sign, "region_id")))


@query(
    "src7_matrix_scan",
    v.sql("matrices", "SELECT 'm' || wm AS wm, pos, " + ", ".join(f"round((round({c}, 4) + 0.5) / (round(a, 4) + round(c, 4) + round(g, 4) + round(t, 4) + 2), 5) AS {c}" for c in "acgt") + " FROM matrices WHERE abs(a + c + g + t - 1) > 0.02 AND wm IN (SELECT wm FROM matrices GROUP BY 1 HAVING min(abs(a + c + g + t - 1)) > 0.02)"),
)
def src7(spark, sf):
    m = v.matrices(spark, sf).withColumn("far", F.abs(F.col("a") + F.col("c") + F.col("g") + F.col("t") - 1))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.concat_ws(" ", F.format_string("%02d", F.col("pos") + 1), *[F.format_string("%.4f", c) for c in "acgt"]).alias("r")))), lambda x: x["r"]), "\n")
    files = m.groupBy("wm").agg(rows.alias("rows"), F.min("far").alias("far")).filter("far > 0.02")
    path = _text(files, spark, "matrices", F.lit("//\nNA m"), F.col("wm").cast("string"), F.lit("\nP0 A C G T\n"), "rows", F.lit("\n//"))
    return s.read_matrices(spark, path).select("wm", "pos", *[F.round(c, 5).alias(c) for c in "acgt"])


@query("src8_site_scan", v.sql("sites", "SELECT region_id, s, e, strand, round(post, 6) AS post, 'w' || wm AS wm FROM sites"))
def src8(spark, sf):
    line = F.concat_ws(" ", F.concat_ws("-", "s", "e"), "strand", F.round("post", 6).cast("string"), F.concat(F.lit("w"), "wm"), F.concat(F.lit("hg_chr1_1_9_"), "region_id", F.lit("_14.9_+")))
    return s.read_sites(spark, _text(v.sites(spark, sf), spark, "sites", line))


@query("src9_maf_scan", v.sql("fastq", "SELECT 'sp' || read_id AS species, read_id % 97 + 1 AS start, len(seq) AS size, '+' AS strand, seq AS text FROM fastq"))
def src9(spark, sf):
    line = F.concat(F.lit("a score=1.0\ns sp"), F.col("read_id").cast("string"), F.lit(" "), (F.col("read_id") % 97).cast("string"), F.lit(" "), F.length("seq").cast("string"), F.lit(" + 1000 "), "seq", F.lit("\n"))
    return s.read_maf(spark, _text(v.fastq(spark, sf), spark, "maf", line)).drop("block")


@query("src10_line_scan", v.sql("tags", "SELECT seq_id, sample FROM tags WHERE sample = 'F' AND seq_id % 10 = 7"))
def src10(spark, sf):
    rows = s.read_lines(spark, _text(v.tags(spark, sf), spark, "lines", F.concat_ws("\t", "seq_id", "sample")), r"7\tF$")
    return rows.select(F.col("fields")[0].cast("long").alias("seq_id"), F.col("fields")[1].alias("sample"))


@query("src10_table_round_trip", v.sql("tags", "SELECT CAST(seq_id AS VARCHAR) AS seq_id, sample FROM tags"))
def src10_save(spark, sf):
    path = s.scratch(spark, "table")
    s.write_table(v.tags(spark, sf).select("seq_id", "sample"), path)
    return s.read_lines(spark, path, "").select(F.col("fields")[0].alias("seq_id"), F.col("fields")[1].alias("sample"))


def _sheet(spark, sf):
    rows = v.tags(spark, sf).groupBy("sample", (F.col("seq_id") % 300).alias("k")).agg(F.array_join(F.collect_list(F.format_string("/data/%s/s%d.bed.gz", "sample", "seq_id")), ",").alias("paths"))
    return _text(rows, spark, "sheet", "sample", F.lit(";"), "paths")


@query("src11_sample_sheet", v.sql("tags", "SELECT '/data/' || sample || '/s' || seq_id || '.bed.gz' AS path, sample AS factor, 'run1_s' || seq_id AS sample_id FROM tags"))
def src11(spark, sf):
    return s.read_samples(spark, _sheet(spark, sf), rename="run1")


@query("src11_new_and_processed", v.sql("tags hits", "SELECT 's' || seq_id AS sample_id, CASE WHEN seq_id IN (SELECT seq_id FROM hits) THEN 'h' || seq_id END AS result FROM tags"))
def src11_split(spark, sf):
    """Samples with hits are processed already and carry their result; the others are new."""
    done = v.hits(spark, sf).select(F.concat(F.lit("s"), "seq_id").alias("sample_id"), F.concat(F.lit("h"), "seq_id").alias("result"))
    new, old = s.split_samples(s.read_samples(spark, _sheet(spark, sf)), done)
    return new.select("sample_id", F.lit(None).cast("string").alias("result")).unionByName(old.select("sample_id", "result"))


@query("src12_wig_sink", v.sql("reads", "SELECT chrom, start AS pos, CAST(count(*) AS DOUBLE) AS level FROM reads GROUP BY ALL"))
def src12(spark, sf):
    path = s.scratch(spark, "wig")
    s.write_wig(v.reads(spark, sf).groupBy("chrom", F.col("start").alias("pos")).agg(F.count("*").cast("double").alias("level")), path, 1)
    body = spark.read.text(path).filter("value not like 'variableStep%' and value not like 'track%'")
    return body.select("chrom", F.split("value", " ")[0].cast("long").alias("pos"), F.split("value", " ")[1].cast("double").alias("level"))


@query(
    "src12_fixed_step",
    v.sql("reads", """, g AS (SELECT chrom, start // 1000 AS k, count(*) AS n FROM reads GROUP BY ALL), e AS (SELECT DISTINCT chrom, unnest(range(44)) AS k FROM reads),
  l AS (SELECT e.chrom, e.k, coalesce(g.n, 0) AS n FROM e LEFT JOIN g ON g.chrom = e.chrom AND g.k = e.k), t AS (SELECT chrom, CAST(n AS DOUBLE) AS level FROM l)
  SELECT chrom, level, count(*) AS times FROM t GROUP BY ALL UNION ALL SELECT DISTINCT chrom, -1.0, 2 FROM e"""),
)
def src12_fixed(spark, sf):
    """Levels of every step of each sequence, and its two header lines."""
    counts = v.reads(spark, sf).groupBy("chrom", F.expr("start div 1000").alias("k")).agg(F.count("*").alias("n"))
    every = v.reads(spark, sf).select("chrom").distinct().select("chrom", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(43).cast("long"))).alias("k")).join(counts, ["chrom", "k"], "left")
    path = s.scratch(spark, "wig")
    s.write_wig(every.select("chrom", (F.col("k") * 1000 + 1).alias("pos"), F.coalesce("n", F.lit(0)).cast("double").alias("level")), path, 1000, fixed=True)
    lines = spark.read.text(path)
    level = F.when(F.col("value").rlike("^(track|fixedStep)"), F.lit(-1.0)).otherwise(F.expr("try_cast(value as double)"))
    return lines.groupBy("chrom", level.alias("level")).agg(F.count("*").alias("times"))


@query("src13_output_per_group", v.sql("reads", "SELECT chrom, count(*) AS n FROM reads GROUP BY 1"))
def src13(spark, sf):
    path = s.scratch(spark, "groups")
    s.write_by_group(v.reads(spark, sf).select("chrom", "start"), path, "chrom")
    return spark.read.parquet(path).groupBy("chrom").agg(F.count("*").alias("n"))


@query("src14_region_scan", v.sql("regions", """SELECT chrom, start, "end", strand, 'ctc-' || chrom || '-' || start || '-' || "end" || '-' || strand AS id FROM regions"""))
def src14(spark, sf):
    r = v.regions(spark, sf)
    flat = F.concat_ws(" ", "chrom", "end", "start", "strand")
    bed = F.concat_ws("\t", "chrom", "start", "end", "region_id", "score", "strand")
    return s.read_regions(spark, _text(r, spark, "regions", F.when(F.col("start") % 2 == 0, flat).otherwise(bed)))
