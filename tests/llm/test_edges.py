"""Every operator and pipeline stage on rows that break things: nulls, empty and very long texts, ties, repeats, clashing names, no rows."""

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, common, dedup, htmltext, langid, licenses, packing, quality, sharding, vectors

#: Columns of documents, and names that the operators use for columns of their own.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, class string, `group` string, size int, n int, ids string, chunk int, label int, shard int, _key string, _score string, _found string, value long"
LONG = "many words of a very long text with no end " * 20_000
TEXTS = [(1, LONG), (2, LONG + "tail"), (None, "a text without an id"), (None, "a text without an id"), (5, "the same row"), (5, "the same row"), (6, None), (7, ""), (8, " \n\t "), (9, "12 34 !!"), (None, None), (10, "x" * 200_000), (11, "Released under the MIT License.")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if t is None else "en", None, None, 99, "clash", "clash", 1, None, "clash", 0, 3, 7, "k", "s", "f", 5) for i, t in TEXTS]
    return spark.createDataFrame(rows, DOCS).cache()


def test_documents(spark, docs):
    n = len(TEXTS)
    ranks = P.path("byte_bpe_multi_50k.tiktoken")
    back = bpe.decode(bpe.encode(docs, ranks, P.PATTERN, packed=True), ranks)
    assert sorted(hashlib.md5(bytes(r["decoded"])).hexdigest() for r in back.collect()) == sorted(hashlib.md5((t or "").encode()).hexdigest() for _, t in TEXTS)
    placed = sharding.shard(docs, shards=3).collect()
    assert sorted((r["size"], r["text_crc32"]) for r in placed) == sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in TEXTS)
    near = dedup.near_duplicates(docs)
    assert near.count() == n and near.filter("doc_id = 2").first()["component_id"] == 1 and near.filter("n_shingles = 0").count() == 4
    pieces = packing.pack(docs, P.path("byte_bpe_50k.json"), 256, keep_ids=False).cache()
    assert pieces.filter("piece = 0").count() == n and pieces.groupBy("sequence_id").agg(F.sum("length").alias("s")).filter("s > 256").count() == 0
    found = langid.identify(docs, langid.train(docs, F.lit(True)))
    assert found.count() == n and found.filter("lang_pred = 'und'").count() == 5
    labels = spark.createDataFrame([(1, 1), (5, 0), (10, 0), (11, 1), (None, 1), (6, None)], "doc_id long, quality int")
    scored = quality.score(docs, quality.train(docs, labels))
    assert scored.count() == n and scored.filter("score between 0 and 1").count() == n and scored.filter("doc_id = 6").first()["score"] == scored.filter("doc_id = 7").first()["score"]
    assert [(r["doc_id"], r["license"]) for r in licenses.scan(docs).collect()] == [(11, "MIT (line)")]


def test_ties(spark):
    """Equal evidence: the first name for languages, the better or first template for licenses."""
    rows = [(1, "abc def", "aa"), (2, "abc def", "bb")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in langid.identify(df, langid.train(df, F.lit(True))).collect()} == {"aa"}
    text = spark.createDataFrame([(1, "Released under the MIT License.")], "doc_id long, text string")
    same = {"b": "Released under the MIT License.", "a": "Released under the MIT License."}
    assert [r["license"] for r in licenses.scan(text, same).collect()] == ["a"]


@pytest.mark.parametrize("at_once", [1, 7, 65_536])
def test_numbered_copies(spark, at_once):
    rows = spark.createDataFrame([(None, 9, "a")] * 40 + [(3, 9, "a")] * 7 + [(3, 9, "b"), (None, None, None)], "doc long, size long, group string")
    got = sorted(map(str, sharding.numbered_copies(rows, at_once).collect()))
    want = [(None, 9, "a", k) for k in range(1, 41)] + [(3, 9, "a", k) for k in range(1, 8)] + [(3, 9, "b", 1), (None, None, None, 1)]
    assert got == sorted(f"Row(doc={d}, size={n}, group={g!r}, copy={k})" for d, n, g, k in want)


def test_odd_links(spark):
    """Links with null, unknown, equal and repeated ends: every row has a place, gapless, and what can be kept together is."""
    docs = spark.createDataFrame([(k if k < 60 else None, f"text number {k} " * (1 + k % 3)) for k in range(64)] + [(5, "again")], "doc_id long, text string")
    pairs = [(1, 2), (2, 1), (1, 2), (7, 7), (None, 3), (3, None), (8, 9999), (8888, 9999), (10, 11)]
    rows = sharding.shard(docs, shards=4, links=spark.createDataFrame(pairs, "a long, b long")).collect()
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in rows) == sorted([*range(60), *[-1] * 4, 5])
    slots, at = {}, {r["doc_id"]: r["shard"] for r in rows}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 4
    assert at[1] == at[2] and at[10] == at[11]
    nothing = sharding.shard(docs, shards=4, links=spark.createDataFrame([], "a long, b long"))
    assert nothing.count() == 65


def test_pages(spark):
    body = "<p>" + " ".join(f"w{k}" for k in range(60_000)) + "</p>"
    rows = [(None, None, None), (None, None, None), (1, "http://h/1", ""), (2, "http://h/2", body), (2, "http://h/2", body), (3, "http://h/3", "<article>" + body), (4, "not a url", "<<<>&#0;&#xD800;&bogus;")]
    df = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], "page_id long, url string, html string, host string, text string, chunk int")
    got = htmltext.extract(df).collect()
    assert len(got) == 7 and sorted(len(r["text"].split()) for r in got if r["page_id"] in (2, 3)) == [0, 0, 60_000]
    assert all(r["text"] == "" and r["n_chars"] == 0 for r in got if r["page_id"] in (None, 1))
    assert htmltext.extract(df.limit(0)).count() == 0


def test_vectors(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, None, None), (4, [], 1), (50, [1.0, 0.1], 1), (6, [1e300, 1e-300], 1), (7, [None, 1.0], 1)]
    df = spark.createDataFrame([(*r, 1, "clash", "clash", 3) for r in rows], "vec_id long, embedding array<double>, label int, id int, class string, v string, block int")
    got = vectors.near_duplicates(df).collect()
    assert len(got) == 8 and sorted(r["n_links"] for r in got) == [0, 0, 0, 4, 4, 4, 4, 4]
    assert [r["kept"] for r in got if r["vec_id"] is None] == [False, False]
    top = vectors.top_k(df.filter("vec_id is null or vec_id <> 6"), df.filter("vec_id = 50"), k=5)
    assert [(r["rank"], r["vec_id"], r["score"]) for r in top.orderBy("rank").collect()] == [(1, 1, 65536), (2, 1, 65536)]


def test_stages(spark, docs, tmp_path):
    """Each stage of the pipeline on such rows and on none; its columns are those of documents."""
    import corpus_pipeline as cp

    spark.createDataFrame([(1, 1, 0), (11, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    sf, none = str(tmp_path), docs.limit(0)
    for _, stage in cp.STAGES[:-1]:
        out = common.table(stage(spark, docs, sf), "stage")
        assert out.columns == list(cp.COLUMNS) and stage(spark, none, sf).count() == 0
    kept = {r["doc_id"] for r in cp.language(spark, docs, sf).collect()}
    assert kept == {1, 2, None, 5, 10, 11}
    one = cp.distinct(spark, docs, sf)
    assert sorted(r["doc_id"] for r in one.filter("doc_id is not null").collect()) == [1, 5, 6, 7, 8, 9, 10, 11] and one.filter("doc_id is null").count() == 2
    assert cp.packed(spark, docs, sf).filter("piece = 0").count() == len(TEXTS) and cp.packed(spark, none, sf).count() == 0
    assert np.unique([r["length"] for r in cp.packed(spark, docs, sf).collect()]).max() <= 2048


def test_empty_models(spark, docs):
    none = docs.limit(0)
    ranks = P.path("byte_bpe_multi_50k.tiktoken")
    assert bpe.decode(bpe.encode(none, ranks, P.PATTERN), ranks).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.train(docs, labels) is None and quality.score(none, None).count() == 0
    model = langid.train(none, F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(docs, model).collect()} == {"und"} and langid.identify(none, model).count() == 0
