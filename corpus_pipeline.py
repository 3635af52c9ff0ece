"""The corpus pipeline over ``documents``: language ID, quality, near-duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the stage before kept and returns the columns of
``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import dedup, langid, packing, quality
from tidemark.llm.common import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Share of its words that a document's language needs; below it no language is that of the document.
LEAST_SHARE = 0.5
#: Quality score below which a document goes.
LEAST_QUALITY = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without letters, and those of which no language has half of the words, go.

    So null and empty texts go, and without any ``lang`` to learn from all do. Rows are judged each for itself: repeated rows and null ids
    fare as their texts do. Columns beside those of ``documents`` are dropped; an empty table stays empty.
    """
    found = langid.identifier(spark, langid.train(docs, F.lit(True)))(F.col("text"))
    rows = docs.select(*COLUMNS, found.alias("_found"))
    return rows.filter("_found.lang_pred <> 'und'").filter(F.col("_found.score") >= LEAST_SHARE).select(*COLUMNS)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is not below the threshold, learned from the labels of those that are here.

    Null and empty texts have the score of the empty n-gram; without labels of both kinds every score is 0.5 and all stay. Repeated rows
    and null ids fare as their texts do. Columns beside those of ``documents`` are dropped; an empty table stays empty.
    """
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.select(*COLUMNS, quality.scorer(spark, model)(F.col("text")).alias("_score"))
    return rows.filter(F.col("_score") >= LEAST_QUALITY).select(*COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest id, null ids last.

    Rows are told apart by their own key (id, then digest of the row), not by doc_id: rows with a null id are documents like
    others, and rows of one id with different texts are decided each for itself. Of rows that are equal throughout one stays;
    rows without words are no near-duplicates, so all of them stay. Columns beside those of ``documents`` are dropped; an
    empty table stays empty.
    """
    number = F.col("doc_id").cast("long")
    # Hexadecimal digits of the id in the order of the ids; "G" comes behind all digits.
    order = F.coalesce(F.lpad(F.hex(number.bitwiseXOR(F.lit(-(2**63)))), 16, "0"), F.lit("G"))
    digest = F.md5(F.to_json(F.struct(*COLUMNS)).cast("binary"))
    keyed = docs.select(*COLUMNS, F.concat_ws("-", order, digest).alias("_key"))
    worded = F.coalesce(F.col("text").rlike(r"[^ \t\n\x0B\f\r]"), F.lit(False))
    rows = keyed.filter(worded)
    kept = dedup.near_duplicates(rows, id_col="_key").filter("kept").select("_key").distinct()
    one = rows.dropDuplicates(["_key"]).join(kept, "_key", "left_semi")
    return one.select(*COLUMNS).unionByName(docs.filter(~worded).select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens.

    A null or empty text is its separator alone; repeated rows and null ids are documents of their own; an empty table gives no rows.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048, separator=0, keep_ids=False)


STAGES = [("language ID", language), ("quality classifier", good), ("MinHash near-dedup", distinct), ("best-fit packing", packed)]
ORACLE_SQL = None  # a trained model and a search for the fewest sequences aren't SQL; tests/llm checks the stages


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages, each stage's result written once to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = table(docs, "stage")
    return docs
