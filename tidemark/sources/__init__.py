"""Readers and writers of text formats. Every reader takes the session and a path that Spark can read."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import sequence as sq


#: Paths that the innermost :func:`tidying` block has made.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def noted(path: str) -> str:
    """``path``, to be deleted at the end of the :func:`tidying` block around, if there is one."""
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def tidying(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what operators wrote on the way inside it.

    Results are lazy and read those tables: write, collect or count them inside the block. What another thread or a block inside makes stays theirs.
    """
    token = _made.set([])
    try:
        yield
    finally:
        made = _made.get() or []
        _made.reset(token)
        for path in made:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share: spark.checkpoint.dir. Only in local mode may it be unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(folder)
    return noted(f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line, value``: lines with the number of their file (from 0) and theirs from 0 in it.

    A scan block is read in order by one task, so a line's place in it is how far its id lies behind the block's first; blocks have one row each (line counts and first ids), and that table is broadcast.
    Lines don't move, and carry no path.
    """
    at = F.monotonically_increasing_id()
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value", at.alias("at"))
    counts = lines.groupBy("path", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    order = Window.partitionBy("path").orderBy("block")
    ahead = counts.select("path", "block", "first", (F.sum("n").over(order) - F.col("n")).alias("ahead"), (F.dense_rank().over(Window.orderBy("path")) - 1).alias("file"))
    return lines.join(F.broadcast(ahead), ["path", "block"]).select("file", (F.col("at") - F.col("first") + F.col("ahead")).alias("line"), "value")


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """``read_id, seq, qual`` of well-formed records of four lines; plain or gzip."""
    parts = numbered_lines(spark, path).groupBy("file", F.expr("line div 4").alias("record")).agg(
        *[F.max(F.when(F.col("line") % 4 == k, F.col("value"))).alias(c) for k, c in enumerate(("head", "seq", "plus", "qual"))]
    )
    good = parts.filter("head like '@%' and plus like '+%' and length(seq) = length(qual)").filter(F.col("seq").rlike("^[A-Za-z.]*$"))
    return good.select(F.substring("head", 2, 1_000_000).alias("read_id"), "seq", "qual")


def write_fastq(df: DataFrame, path: str) -> None:
    df.select(F.concat(F.lit("@"), F.col("read_id").cast("string"), F.lit("\n"), "seq", F.lit("\n+\n"), "qual")).write.text(path)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """``tag_id, n, seq``: records with one or more sequence lines, an optional count behind the id; letters but ACGT become N."""
    records = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", r"^>|\n$", "").alias("r")).filter("r <> ''")
    head, body = F.substring_index("r", "\n", 1), F.expr("substr(r, length(substring_index(r, '\\n', 1)) + 2)")
    name, count = F.split(head, r"\s+")[0], F.try_to_number(F.regexp_extract(head, r"\s(\d+)\s*$", 1), F.lit("999999999999")).cast("long")
    return records.select(name.alias("tag_id"), F.coalesce(count, F.lit(1)).alias("n"), sq.normalise(F.replace(body, F.lit("\n"), F.lit(""))).alias("seq"))


def read_fasta_chunks(spark: SparkSession, path: str, size: int, halo: int = 0) -> DataFrame:
    """``tag_id, n, chunk, origin, seq``: each record in chunks of ``size`` letters, each with up to ``halo`` letters of the next, so that no sequence is one row.

    Scan blocks are read in order, each by one task. Two short scans tell for each block (one row each) which record goes on into it and how many letters that has by then; so a task that reads a block cuts its
    lines into chunks where they are, and only pieces of chunks over two blocks move. Records without letters have no chunk. Letters but ACGT become N.
    """
    at, value = F.monotonically_increasing_id(), F.regexp_replace("value", r"\s+$", "")
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), at.alias("at"), value.alias("value"))
    head, letters, key = F.col("value").startswith(">"), F.length("value").cast("long"), ["path", "block"]
    lasts = lines.filter(head).groupBy(*key).agg(F.max(F.struct("at", F.substring("value", 2, 1_000_000).alias("name"))).alias("last"))
    text = lines.filter(~head).join(F.broadcast(lasts), key, "left").groupBy(*key).agg(F.sum(letters).alias("all"), F.sum(F.when(F.col("last").isNull() | (F.col("at") > F.col("last.at")), letters)).alias("tail"))
    known: dict[tuple[str, int], tuple] = {}
    files: dict[str, int] = {}
    for r in lasts.join(text, key, "full").orderBy(*key).collect():
        if r["path"] not in files:
            files[r["path"]], past = len(files), (None, None, 0)
        known[r["path"], r["block"]] = (files[r["path"]], *past)
        past = (r["last"]["at"], r["last"]["name"], r["tail"] or 0) if r["last"] else (*past[:2], past[2] + (r["all"] or 0))

    def pieces(frames):
        rows, held, block = [], [], None
        file, head, name, begin, chunk = 0, None, None, 0, 0

        def cut(over: bool, ended: bool) -> None:
            """Gives the chunks of what is held, with ``over`` also unfinished ones; with ``ended`` the record has no more letters."""
            nonlocal held, begin, chunk
            letters = "".join(held) if head is not None else ""
            stop = begin + len(letters)
            while chunk * size < stop and (over or chunk * size + size + halo <= stop):
                low, high = chunk * size, chunk * size + size + halo
                first = max(low, begin)
                if part := letters[first - begin : high - begin]:
                    rows.append((file, head, name, chunk, first, part, first == low and (ended or high <= stop)))
                chunk += 1
            kept = max(begin, min(chunk * size, stop))
            held, begin = [letters[kept - begin :]], kept

        for frame in frames:
            values, ids, paths, blocks = (frame[c].to_numpy() for c in ("value", "at", "path", "block"))
            heads = frame["value"].str.startswith(">").to_numpy(dtype=bool)
            turns = (blocks[1:] != blocks[:-1]) | (paths[1:] != paths[:-1])
            edges = sorted({0, *(k + 1 for k in turns.nonzero()[0]), *heads.nonzero()[0]}) if len(values) else []
            for i, j in zip(edges, [*edges[1:], len(values)], strict=True):
                if (paths[i], blocks[i]) != block:
                    cut(True, False)
                    block = (paths[i], blocks[i])
                    file, head, name, begin = known.get(block, (0, None, None, 0))
                    held, chunk = [], max(0, (begin - halo) // size)
                if heads[i]:
                    cut(True, True)
                    head, name, begin, chunk, held = int(ids[i]), values[i][1:], 0, 0, []
                    i += 1
                held.extend(values[i:j])
            cut(False, False)
            if rows:
                yield pd.DataFrame(rows, columns=["file", "head", "name", "chunk", "first", "part", "whole"])
                rows.clear()
        cut(True, False)
        if rows:
            yield pd.DataFrame(rows, columns=["file", "head", "name", "chunk", "first", "part", "whole"])

    made = lines.mapInPandas(pieces, "file int, head long, name string, chunk long, first long, part string, whole boolean")
    parts = made.filter("not whole").groupBy("file", "head", "chunk").agg(F.first("name").alias("name"), F.array_sort(F.collect_list(F.struct("first", "part"))).alias("p"))
    whole = made.filter("whole").select("name", "chunk", "part").unionByName(parts.select("name", "chunk", F.array_join("p.part", "").alias("part")))
    count = F.try_to_number(F.regexp_extract("name", r"\s(\d+)\s*$", 1), F.lit("999999999999")).cast("long")
    return whole.select(F.split("name", r"\s+")[0].alias("tag_id"), F.coalesce(count, F.lit(1)).alias("n"), "chunk", (F.col("chunk") * size).alias("origin"), sq.normalise(F.col("part")).alias("seq"))


def read_tag_table(spark: SparkSession, path: str) -> DataFrame:
    """``tag_id, n, seq`` of a table by tabs: ``seq``, ``id seq``, ``id seq n`` or ``seq n`` (the second field a number); letters but ACGT become N."""
    f = spark.read.text(path).filter("trim(value) <> ''").select(F.split("value", "\t").alias("f"))
    get = lambda k: F.get("f", F.lit(k))
    counted = (F.size("f") == 2) & get(1).rlike(r"^\d+$")
    seq = F.when((F.size("f") == 1) | counted, get(0)).otherwise(get(1))
    n = F.when(counted, get(1)).when(F.size("f") >= 3, get(2)).cast("long")
    return f.select(F.when((F.size("f") == 1) | counted, seq).otherwise(get(0)).alias("tag_id"), F.coalesce(n, F.lit(1)).alias("n"), sq.normalise(seq).alias("seq"))


def import_tags(spark: SparkSession, path: str) -> DataFrame:
    """``tag_id, seq, n`` of a table ``seq<tab>n``: upper case, U as T; sequences with other than letters, and repeated ones, are refused; ids sq1 ... in order of sequence."""
    rows = spark.read.text(path).select(F.split("value", "\t").alias("f")).select(F.replace(F.upper(F.col("f")[0]), F.lit("U"), F.lit("T")).alias("seq"), F.col("f")[1].cast("long").alias("n"))
    once = rows.filter(F.col("seq").rlike("^[A-Z]+$")).groupBy("seq").agg(F.count("*").alias("copies"), F.sum("n").alias("n")).filter("copies = 1")
    from ..operators.intervals import running_total

    return running_total(once.withColumn("one", F.lit(1)), "one", [F.col("seq")], "k").select(F.concat(F.lit("sq"), F.col("k").cast("string")).alias("tag_id"), "seq", "n")


BED = "chrom string, start long, end long, id string, weight double, strand string"


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=BED, comment="#")


def write_bed(df: DataFrame, path: str) -> None:
    df.select("chrom", "start", "end", "id", "weight", "strand").write.csv(path, sep="\t", compression="gzip")


def read_repeats(spark: SparkSession, path: str) -> DataFrame:
    """``chrom, start, end, strand`` of lines whose first field is a whole number; 1-based starts become 0-based, C is the minus strand."""
    f = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("f")).filter(F.get("f", F.lit(0)).rlike(r"^\d+$"))
    return f.select(F.get("f", F.lit(4)).alias("chrom"), (F.get("f", F.lit(5)).cast("long") - 1).alias("start"), F.get("f", F.lit(6)).cast("long").alias("end"), F.when(F.get("f", F.lit(8)) == "+", "+").otherwise("-").alias("strand"))


def read_genes(spark: SparkSession, path: str) -> DataFrame:
    """Gene annotation of six columns; strand 1 and -1 become + and -."""
    genes = spark.read.csv(path, sep="\t", schema="chrom string, start long, end long, name string, strand int, id string", comment="#")
    return genes.withColumn("strand", F.when(F.col("strand") == 1, "+").otherwise("-"))


def read_matrices(spark: SparkSession, path: str) -> DataFrame:
    """``wm, pos, a, c, g, t`` of matrix files: rows after P0 or PO, a pseudo-count by the rows' sum, rows scaled to 1."""
    blocks = spark.read.option("lineSep", "//\n").text(path).filter(F.col("value").rlike(r"(?m)^NA\s"))
    rows = blocks.select(F.regexp_extract("value", r"(?m)^NA\s+(\S+)", 1).alias("wm"), F.explode(F.split("value", "\n")).alias("line")).filter(F.col("line").rlike(r"^\d+\s"))
    f = F.split(F.trim("line"), r"\s+")
    cells = rows.select("wm", (f[0].cast("int") - 1).alias("pos"), *[f[k + 1].cast("double").alias(c) for k, c in enumerate("acgt")])
    total = F.col("a") + F.col("c") + F.col("g") + F.col("t")
    pseudo = F.when(F.abs(total - 1) < 0.01, 0.0001).otherwise(0.5)
    return cells.select("wm", "pos", *[((F.col(c) + pseudo) / (total + 4 * pseudo)).alias(c) for c in "acgt"])


def reversed_matrices(matrices: DataFrame) -> DataFrame:
    """The matrices of the other strand: positions backwards, A with T and C with G exchanged."""
    size = F.max("pos").over(Window.partitionBy("wm"))
    return matrices.select("wm", (size - F.col("pos")).alias("pos"), *[F.col(x).alias(c) for c, x in zip("acgt", "tgca", strict=True)])


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """Site lines ``s-e strand posterior motif key``; the region's id is the third from last part of the key."""
    f = F.split("value", r"\s+")
    rows = spark.read.text(path).select(f.alias("f")).filter(F.size("f") >= 5)
    span = F.split(F.col("f")[0], "-")
    return rows.select(F.element_at(F.split(F.col("f")[4], "_"), -3).alias("region_id"), span[0].cast("long").alias("s"), span[1].cast("long").alias("e"), F.col("f")[1].alias("strand"), F.col("f")[2].cast("double").alias("post"), F.col("f")[3].alias("wm"))


def read_maf(spark: SparkSession, path: str) -> DataFrame:
    """``block, species, start, size, strand, text``: one row an ``s`` line of alignment blocks, starts 1-based; the block is named by its first line."""
    blocks = spark.read.option("lineSep", "\n\n").text(path).filter(F.col("value").contains("a score="))
    lines = blocks.select(F.sha2(F.col("value"), 256).alias("block"), F.explode(F.split("value", "\n")).alias("line")).filter("line like 's %'")
    f = F.split("line", r"\s+")
    return lines.select("block", f[1].alias("species"), (f[2].cast("long") + 1).alias("start"), f[3].cast("long").alias("size"), f[4].alias("strand"), f[6].alias("text"))


def read_lines(spark: SparkSession, path: str, pattern: str, sep: str = "\t") -> DataFrame:
    """Fields of the lines that match a pattern."""
    return spark.read.text(path).filter(F.col("value").rlike(pattern)).select(F.split("value", sep).alias("fields"))


def write_table(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Rows as delimited lines, null as an empty field."""
    df.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]).alias("value")).write.text(path)


def read_samples(spark: SparkSession, path: str, rename: str | None = None) -> DataFrame:
    """``path, factor, sample_id``: a sheet ``factor;path,path...`` as one row a file; ids are file names without their endings, with ``rename_`` before them if given."""
    f = F.split("value", ";")
    # The factor is cut off before the paths are laid out: next to explode it would be cut from the whole line again for each of its paths.
    sheet = spark.read.text(path).select(f[0].alias("factor"), F.split(f[1], ",").alias("paths"))
    rows = sheet.select("factor", F.explode("paths").alias("path"))
    stem = F.regexp_replace(F.substring_index("path", "/", -1), r"(\.(gz|bedweight|bed|fastq|fq|fasta|fa))+$", "")
    return rows.select("path", "factor", (F.concat(F.lit(f"{rename}_"), stem) if rename else stem).alias("sample_id"))


def split_samples(samples: DataFrame, processed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The samples that are still to be processed, and those whose ``sample_id`` is in ``processed`` with its ``result``."""
    done = processed.select("sample_id", "result").dropDuplicates(["sample_id"])
    return samples.join(done, "sample_id", "left_anti"), samples.join(done, "sample_id")


def write_wig(df: DataFrame, path: str, step: int, name: str = "track", description: str = "", fixed: bool = False) -> None:
    """A wig track of ``chrom, pos, level``, a folder a sequence: the track's header, then variableStep lines ``pos level``, or with ``fixed`` levels
    alone, in which case every ``step`` from 1 on must be there. Levels have two digits. A sequence is range-partitioned by position and
    written in as many parts as it has tiles; parts are in order by name, the headers in the first."""
    kind = "fixedStep chrom=%s start=1 step=" + f"{step} span={step}" if fixed else f"variableStep chrom=%s span={step}"
    track = f'track type=wiggle_0 name="{name}" description="{description}"'
    head = df.select("chrom").distinct().select("chrom", F.lit(-1).cast("long").alias("pos"), F.concat(F.lit(track + "\n"), F.format_string(kind, "chrom")).alias("value"))
    level = F.format_string("%.2f", F.col("level").cast("double"))
    body = df.select("chrom", F.col("pos").cast("long").alias("pos"), (level if fixed else F.concat_ws(" ", "pos", level)).alias("value"))
    parts = head.unionByName(body).repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos")
    parts.select("chrom", "value").write.partitionBy("chrom").text(path)


def write_by_group(df: DataFrame, path: str, key: str) -> None:
    """One folder a group; a large group is written by several tasks, of some of its rows each."""
    df.repartitionByRange(F.col(key), F.xxhash64(*df.columns)).write.partitionBy(key).parquet(path)


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """Regions of four columns by space or BED by tab, # lines skipped, reversed ends swapped, id ``ctc-chrom-start-end-strand``."""
    lines = spark.read.text(path).filter("value not like '#%' and trim(value) <> ''")
    bed = F.col("value").contains("\t")
    f = F.when(bed, F.split("value", "\t")).otherwise(F.split(F.trim("value"), r"\s+"))
    rows = lines.select(f.alias("f"), bed.alias("bed"))
    strand = F.when(F.col("bed"), F.coalesce(F.get("f", F.lit(5)), F.lit("+"))).otherwise(F.coalesce(F.get("f", F.lit(3)), F.lit("+")))
    a, b = F.col("f")[1].cast("long"), F.col("f")[2].cast("long")
    out = rows.select(F.col("f")[0].alias("chrom"), F.least(a, b).alias("start"), F.greatest(a, b).alias("end"), strand.alias("strand"))
    return out.withColumn("id", F.concat_ws("-", F.lit("ctc"), "chrom", "start", "end", "strand"))
