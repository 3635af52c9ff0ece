"""The queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, dedup, fingerprints, htmltext, langid, licenses, negatives, packing, periods, quality, sharding, vectors
from .common import held_out


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_balanced_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_read(spark, sf_dir, "documents"), shards=24)


def op2_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(_read(spark, sf_dir, "pages"))


def op3_bottom_k_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near_duplicates(_read(spark, sf_dir, "documents"), words=4, percent=80)


def op4_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode(_read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, packed=True)
    return bpe.decode(ids, ranks).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    out = held_out(F.col("doc_id"), 5, 0)
    model = quality.train(docs, labels.filter(~out))
    return quality.score(docs, model, threshold=0.3).select("doc_id", out.alias("held_out"), "score", "predicted")


def op6_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 3, 1)
    model = langid.train(docs, ~out)
    return langid.identify(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score", "languages", "shares")


def op7_columnar_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors_ = _read(spark, sf_dir, "embeddings")
    return vectors.top_k(vectors_, vectors_.filter(F.col("vec_id") % 50 == 0), k=5, scale=256)


def op8_license_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_read(spark, sf_dir, "documents"))


def op9_bin_completion_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(_read(spark, sf_dir, "documents"), vocabulary, 2048, separator=0, keep_ids=False)


def op10_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_read(spark, sf_dir, "embeddings"), threshold=0.93)


def _periodic(docs: DataFrame) -> DataFrame:
    """Every tenth document (by hash of its id) with a periodic end: its words from one place on repeat their first ones."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("w"))
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    a = (g % n).cast("int")
    cut = words.select("doc_id", "text", "w", n.alias("n"), a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).cast("int").alias("p"))
    unit, rest = F.slice("w", F.col("a") + 1, F.col("p")), F.col("n") - F.col("a")
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    changed = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")
    return cut.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))


def op11_lyndon_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(_periodic(_read(spark, sf_dir, "documents")), least_length=6, least_exponent=4)
    longer = lambda a, b: (a["length"] * b["period"] > b["length"] * a["period"]) | a.isNull()
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(longer(r, b), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", "best.*", F.expr("(1000 * best.length) div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_one_permutation_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    rows = fingerprints.with_next(docs, {"packed": F.unhex(fingerprints.fingerprint(F.col("text")))})  # half the bytes to move
    digits = lambda c: F.lower(F.hex(c))
    rows = rows.withColumn("fingerprint", digits("packed")).withColumn("next_fingerprint", digits("next_packed"))
    rows = rows.withColumn("edited", fingerprints.replaced_end(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("edited_fingerprint", fingerprints.fingerprint(F.col("edited")))
    return rows.select(
        F.col("id").alias("doc_id"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        fingerprints.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        fingerprints.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def op13_anchor_shared_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _read(spark, sf_dir, "embeddings").withColumn("label", label)
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=5, percent=(80, 100), scale=256)


QUERIES = {
    f.__name__: f
    for f in (
        op1_balanced_label_propagation,
        op2_host_suffix_array,
        op3_bottom_k_minhash,
        op4_segment_tree_bpe,
        op5_nbsvm_quality,
        op6_language_mixture,
        op7_columnar_topk,
        op8_license_compression,
        op9_bin_completion_packing,
        op10_inverted_multi_index,
        op11_lyndon_runs,
        op12_one_permutation_fingerprint,
        op13_anchor_shared_lists,
    )
}

_VECTORS = """
usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""

ORACLE_SQL: dict[str, str] = {
    "op3_bottom_k_minhash": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS s FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS x FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
half AS (SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
         WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
lowest AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, d.n AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(l.b, d.doc_id)) AS kept
FROM sizes d LEFT JOIN lowest l ON l.a = d.doc_id""",
    "op7_columnar_topk": f"""
WITH {_VECTORS.strip()},
whole AS (SELECT vec_id, list_transform(v, lambda x: floor(256 * x)) AS v FROM usable WHERE vec_id IS NOT NULL),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op11_lyndon_runs": r"""
WITH hashed AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(4294967295, list_reduce(list_concat([4294967295], flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])),
           lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS h FROM documents),
cut AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS made, (h // 10) % greatest(len(w), 1) AS a, h // 10 AS g FROM hashed),
texts AS (
  SELECT doc_id, n, CASE WHEN made THEN list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE w END AS w FROM cut),
words AS (SELECT doc_id, n, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM texts),
pairs AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM words a JOIN words b ON a.doc_id = b.doc_id AND a.x = b.x AND a.i < b.i AND 4 * (b.i - a.i) <= a.n),
marked AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS isle FROM pairs),
isles AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM marked GROUP BY doc_id, q, isle HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT * FROM isles r WHERE NOT EXISTS (SELECT 1 FROM isles o WHERE o.doc_id = r.doc_id AND o.q < r.q AND o.s <= r.s AND o.s + o.l >= r.s + r.l)),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CAST(l AS DOUBLE) / q DESC, s, q) AS k, count(*) OVER (PARTITION BY doc_id) AS n_runs FROM runs),
lines AS (SELECT doc_id, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM runs GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT w.doc_id, string_agg(x, ' ' ORDER BY w.i) AS t FROM words w ANTI JOIN dropped d ON d.doc_id = w.doc_id AND d.i = w.i GROUP BY w.doc_id)
SELECT t.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(s AS BIGINT) AS start, CAST(l AS BIGINT) AS length, CAST(q AS BIGINT) AS period, CAST(1000 * l // q AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM texts t LEFT JOIN best ON best.doc_id = t.doc_id AND k = 1 LEFT JOIN lines ON lines.doc_id = t.doc_id LEFT JOIN kept ON kept.doc_id = t.doc_id""",
    "op10_inverted_multi_index": f"""
WITH RECURSIVE {_VECTORS.strip()},
fit AS (SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS norm FROM usable
        WHERE label IS NOT NULL AND list_dot_product(v, v) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fit a JOIN fit b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
   AND list_dot_product(a.v, b.v) >= 0.93 * a.norm * b.norm),
reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
lowest AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(lowest.b, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(lowest.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN lowest ON lowest.a = e.vec_id LEFT JOIN counts ON counts.a = e.vec_id""",
    "op13_anchor_shared_lists": f"""
WITH {_VECTORS.strip()},
whole AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(v, lambda x: floor(256 * x)) AS v
          FROM usable WHERE vec_id IS NOT NULL AND label IS NOT NULL),
scores AS (
  SELECT a.vec_id AS anchor, c.vec_id AS other, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM whole a JOIN whole c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor, other, score FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.other AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
       n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other) <= 5""",
}
