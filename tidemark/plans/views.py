"""Input views over the driver's tables: as DataFrames, and as SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Length of every sequence of the ``reads`` and ``regions`` views.
SPAN = 43_200


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    wall = "unix_micros(from_utc_timestamp(cast(ts as timestamp), current_timezone()))"
    return read(spark, sf_dir, "events").selectExpr(
        "event_id", "event_type as chrom", f"({wall} - 1704067200000000) div 60000000 as start",
        f"({wall} - 1704067200000000) div 60000000 + 36 as end", "if(event_id % 2 = 0, '+', '-') as strand",
        "1 + user_id % 3 as n", "1 + event_id % 4 as hits", "cast(1 + user_id % 3 as double) / (1 + event_id % 4) as weight",
        "if((event_id div 4) % 4 < 2, 'fg', 'bg') as role", "(event_id div 4) % 2 as replicate",
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    chrom = "element_at(array('click', 'error', 'purchase', 'signup', 'view'), cast(o_orderkey % 5 as int) + 1)"
    return read(spark, sf_dir, "orders").selectExpr(
        "concat('reg', 1000000 + o_orderkey) as region_id", f"{chrom} as chrom", "(o_orderkey * 7919) % 42000 as start",
        "(o_orderkey * 7919) % 42000 + 100 + o_orderkey % 900 as end", "cast(o_totalprice as double) / 10000 as score",
        "if(o_custkey % 2 = 0, '+', '-') as strand",
    )


#: Further sequences that the ``scattered`` view deals each sequence's regions to.
SPREAD = 211


def scattered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All regions, dealt over many more sequences, so that most lie apart."""
    part = read(spark, sf_dir, "orders").selectExpr("concat('reg', 1000000 + o_orderkey) as region_id", f"o_custkey % {SPREAD} as part")
    return regions(spark, sf_dir).join(part, "region_id").withColumn("chrom", F.concat_ws("_", "chrom", "part")).drop("part")


def _acgt(text: str = "text") -> str:
    return f"regexp_replace(translate(lower({text}), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC'), '[^ACGT]', 'N')"


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").selectExpr("doc_id", f"{_acgt()} as seq")


#: Letters of a read of the ``fastq`` view, and reads that one text may have (read ids are text ids times this plus the read's number).
READ, READS = 36, 10_000_000
_QUAL = "translate(lower({text}), 'abcdefghijklmnopqrstuvwxyz', '0123456789:;<=>?@ABCDEFGHI'), '[^0-J]', '#'"


def fastq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text, cut into reads."""
    parts = lambda x: f"regexp_extract_all({x}, '.{{1,{READ}}}', 0)"
    qual = f"regexp_replace({_QUAL.format(text='text')})"
    cut = read(spark, sf_dir, "documents").selectExpr("doc_id", f"{parts(_acgt())} as seq", f"{parts(qual)} as qual")
    return cut.selectExpr("doc_id", "posexplode(arrays_zip(seq, qual)) as (k, r)").selectExpr(f"doc_id * {READS} + k as read_id", "r.seq", "r.qual")


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments: three reads of a text after one another are the rows of a block's species 0, 1 and 2; N is a gap."""
    k = f"read_id % {READS}"
    return fastq(spark, sf_dir).selectExpr(f"read_id div {READS} * {READS} + {k} div 3 as block", f"cast({k} % 3 as int) as species", "translate(seq, 'N', '-') as text")


#: The adaptor of the ``tailed`` view, and what its reads carry by turns: the whole of it, with a letter replaced, one left out, one
#: put in, a part with letters replaced, a short part, nothing.
ADAPTOR = "GATCACTGATGCATTG"
TAILS = (ADAPTOR, "GATCACTAATGCATTG", "GATCACGATGCATTGA", "GATCACTTGATGCATT", "GATCACTGATG", "GATCTCTGA", "GATCACTCATGC", "GATC", "")


def tailed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads (14 letters of ``fastq``) with an adaptor's part behind them, in a third of them also more letters, and in another third the adaptor's end before them."""
    tail = "element_at(array(" + ", ".join(f"'{x}'" for x in TAILS) + f"), cast(read_id % {len(TAILS)} as int) + 1)"
    head = f"if(read_id % 3 = 1, '{ADAPTOR[-9:]}', '')"
    return fastq(spark, sf_dir).selectExpr("read_id", f"concat({head}, substr(seq, 1, 14), {tail}, if(read_id % 3 = 2, substr(seq, 15, 12), '')) as seq", "1 + read_id % 5 as n")


#: The 5' adaptor of the ``tagged`` view, and what stands before its tags by turns: all of it, with a letter replaced, left out, put in,
#: a part with letters replaced, a part with a letter left out, a short part, nothing.
FIVE = "TCTACAGTCCGAGC"
HEADS = (FIVE, "TCTACAGTACGAGC", "TCTACATCCGAGC", "TCTACAGGTCCGAG", "ACTGTACGAGC", "CAGTCGAGC", "GAGC", "")


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of 14 to 20 letters of the reads between parts of both adaptors, in all combinations; every ninth ends in more letters."""
    pick = lambda x, k: f"element_at(array({', '.join(repr(t) for t in x)}), cast({k} % {len(x)} as int) + 1)"
    more = "if(read_id % 81 < 9, 'ACGA', '')"
    seq = f"concat({pick(HEADS, 'read_id div 9')}, substr(seq, 1, cast(14 + read_id % 7 as int)), {pick(TAILS, 'read_id')}, {more})"
    return fastq(spark, sf_dir).selectExpr(f"{seq} as seq", "read_id as id", "1 + read_id % 5 as n")


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as seq_id", "l_partkey % 50 as target_id", "if(l_linestatus = 'O', '+', '-') as strand",
        "l_suppkey * 37 as start", "l_suppkey * 37 + 35 as end", "cast(l_linenumber % 3 as int) as err",
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr("o_orderkey as seq_id", "o_orderstatus as sample", "1 + o_custkey % 5 as n")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").selectExpr(
        "concat('reg', 1000000 + l_orderkey) as region_id", "l_orderkey", "l_linenumber", "l_partkey % 10 as wm",
        "l_suppkey * 3 % 900 as s", "l_suppkey * 3 % 900 + 10 as e", "if(l_linestatus = 'O', '+', '-') as strand",
        "cast(l_discount as double) * 10 as post",
    )


def matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("pos"))
    cell = lambda k: F.abs(F.get("embedding", 4 * F.col("pos") + k)).cast("double")
    return base.select(F.col("vec_id").alias("wm"), "pos", cell(0).alias("a"), cell(1).alias("c"), cell(2).alias("g"), cell(3).alias("t"))


_ACGT_SQL = "regexp_replace(translate(lower(text), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC'), '[^ACGT]', 'N', 'g')"
SQL = {
    "reads": """reads AS (SELECT event_id, event_type AS chrom,
  CAST((epoch_us(ts) - 1704067200000000) // 60000000 AS BIGINT) AS start,
  CAST((epoch_us(ts) - 1704067200000000) // 60000000 AS BIGINT) + 36 AS "end",
  CASE WHEN event_id % 2 = 0 THEN '+' ELSE '-' END AS strand, 1 + user_id % 3 AS n, 1 + event_id % 4 AS hits,
  CAST(1 + user_id % 3 AS DOUBLE) / (1 + event_id % 4) AS weight,
  CASE WHEN (event_id // 4) % 4 < 2 THEN 'fg' ELSE 'bg' END AS role, (event_id // 4) % 2 AS replicate FROM events)""",
    "regions": """regions AS (SELECT 'reg' || CAST(1000000 + o_orderkey AS VARCHAR) AS region_id,
  ['click', 'error', 'purchase', 'signup', 'view'][1 + CAST(o_orderkey % 5 AS INTEGER)] AS chrom,
  CAST((o_orderkey * 7919) % 42000 AS BIGINT) AS start, CAST((o_orderkey * 7919) % 42000 + 100 + o_orderkey % 900 AS BIGINT) AS "end",
  CAST(o_totalprice AS DOUBLE) / 10000 AS score, CASE WHEN o_custkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM orders)""",
    "scattered": f"scattered AS (SELECT region_id, chrom || '_' || o_custkey % {SPREAD} AS chrom, start, \"end\", score, strand FROM regions JOIN orders ON region_id = 'reg' || CAST(1000000 + o_orderkey AS VARCHAR))",
    "sequences": f"sequences AS (SELECT doc_id, {_ACGT_SQL} AS seq FROM documents)",
    "fastq": f"""fastq_cut AS (SELECT doc_id, regexp_extract_all({_ACGT_SQL}, '.{{1,{READ}}}') AS seqs, regexp_extract_all(regexp_replace({_QUAL.format(text="text")}, 'g'), '.{{1,{READ}}}') AS quals FROM documents),
  fastq AS (SELECT doc_id * {READS} + k AS read_id, seqs[k + 1] AS seq, quals[k + 1] AS qual FROM (SELECT *, unnest(range(len(seqs))) AS k FROM fastq_cut))""",
    "aligned": f"aligned AS (SELECT read_id // {READS} * {READS} + read_id % {READS} // 3 AS block, read_id % {READS} % 3 AS species, translate(seq, 'N', '-') AS text FROM fastq)",
    "tailed": f"""tailed AS (SELECT read_id, CASE WHEN read_id % 3 = 1 THEN '{ADAPTOR[-9:]}' ELSE '' END || substr(seq, 1, 14)
  || list_extract([{", ".join(f"'{x}'" for x in TAILS)}], CAST(read_id % {len(TAILS)} AS INTEGER) + 1) || CASE WHEN read_id % 3 = 2 THEN substr(seq, 15, 12) ELSE '' END AS seq, 1 + read_id % 5 AS n FROM fastq)""",
    "tagged": f"""tagged AS (SELECT list_extract([{", ".join(f"'{x}'" for x in HEADS)}], CAST(read_id // 9 % {len(HEADS)} AS INTEGER) + 1) || substr(seq, 1, CAST(14 + read_id % 7 AS INTEGER))
  || list_extract([{", ".join(f"'{x}'" for x in TAILS)}], CAST(read_id % {len(TAILS)} AS INTEGER) + 1) || CASE WHEN read_id % 81 < 9 THEN 'ACGA' ELSE '' END AS seq, read_id AS id, 1 + read_id % 5 AS n FROM fastq)""",
    "hits": """hits AS (SELECT l_orderkey AS seq_id, l_partkey % 50 AS target_id,
  CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, l_suppkey * 37 AS start, l_suppkey * 37 + 35 AS "end",
  CAST(l_linenumber % 3 AS INT) AS err FROM lineitem)""",
    "tags": "tags AS (SELECT o_orderkey AS seq_id, o_orderstatus AS sample, 1 + o_custkey % 5 AS n FROM orders)",
    "sites": """sites AS (SELECT 'reg' || CAST(1000000 + l_orderkey AS VARCHAR) AS region_id, l_orderkey, l_linenumber, l_partkey % 10 AS wm,
  CAST(l_suppkey * 3 % 900 AS BIGINT) AS s, CAST(l_suppkey * 3 % 900 + 10 AS BIGINT) AS e,
  CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, CAST(l_discount AS DOUBLE) * 10 AS post FROM lineitem)""",
    "matrices": """matrices AS (SELECT vec_id AS wm, CAST(p.i AS INT) AS pos, CAST(abs(embedding[4*p.i+1]) AS DOUBLE) AS a,
  CAST(abs(embedding[4*p.i+2]) AS DOUBLE) AS c, CAST(abs(embedding[4*p.i+3]) AS DOUBLE) AS g, CAST(abs(embedding[4*p.i+4]) AS DOUBLE) AS t
  FROM embeddings CROSS JOIN (SELECT unnest(range(16)) AS i) p)""",
}


def sql(views: str, body: str) -> str:
    """The query ``body`` after the named views (separated by spaces) and its own further views, which begin with a comma."""
    return "WITH " + ",\n".join(SQL[v] for v in views.split()) + "\n" + body.strip()
