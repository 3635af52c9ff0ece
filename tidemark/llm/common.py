"""Helpers that several training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that Python takes out of an Arrow batch at a time, so that long texts never sit in memory twice.
SLICE = 256


#: What a Python worker keeps between its tasks.
_kept: dict = {}


def kept(key, build: Callable):
    """``build()``, once in a worker for a key: a memory of words outlives the task that made it, until another one is asked for."""
    if key not in _kept:
        _kept.clear()  # a worker that several operators use never holds the memories of all
        pa.default_memory_pool().release_unused()
        _kept[key] = build()
    return _kept[key]


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only in local mode (tests) may it be unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: it cuts the lineage and outlives any executor."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def forget(*frames: DataFrame) -> None:
    """Delete the files of tables that no later plan reads."""
    for df in frames:
        if path := getattr(df, "_tidemark_path", None):
            jvm = df.sparkSession._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE) -> Iterator[dict[str, list]]:
    """Python columns of at most ``size`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size).to_pydict()


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[dict], dict]], size: int = SLICE) -> DataFrame:
    """``mapInArrow`` with a function from a slice's columns to the result's columns; ``make`` builds it once a task."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for columns in slices(batches, size):
            out = function(columns)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def held_out(doc_id: F.Column, folds: int, fold: int) -> F.Column:
    """True for the rows of one fold of ``crc32(doc_id as text)``; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """Connected components of an edge list: ``node, root`` with the smallest node of each component as its root.

    Alternates large-star and small-star steps. Every step is one aggregation by node and one join on that node, so a
    node with very many neighbours is pre-aggregated before the shuffle and its join partition can be split. Nodes
    without an edge are not in the result. The driver sees only two numbers a round.
    """
    at = table(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges"
    )
    state = None
    for _ in range(most_rounds):
        both = at.unionByName(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(lower.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        new = table(small, "edges")
        now = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        forget(at)
        at = new
        if tuple(now) == state:
            break
        state = tuple(now)
    roots = at.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return at.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
