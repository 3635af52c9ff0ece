"""Chunks of records over scan blocks, spans cut in one chunk each, peaks beside their sites, single blocks."""

import random

from tidemark import sources as s
from tidemark.operators.synteny import best_runs
from tidemark.plans import q_scores as q

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_chunks_over_blocks(spark, tmp_path):
    """Records within a block, over many, without letters, lines before the first header; two files; no line is moved."""
    rng = random.Random(2)
    want = []
    for f in "ab":
        text = "TTTT\n" if f == "b" else ""
        for k in range(30):
            seq = "".join(rng.choice("ACGT") for _ in range(rng.choice((0, 1, 19, 20, 21, 40, 300, 1500))))
            text += f">{f}{k} {k + 1}\n" + "".join(seq[i : i + 7] + "\n" for i in range(0, len(seq), 7))
            want += [(f"{f}{k}", k + 1, i // 20, i, seq[i : i + 25]) for i in range(0, len(seq), 20)]
        (tmp_path / f"{f}.txt").write_text(text)
    keep = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("100b", "1000b", "128m"):
            for c in keep:
                spark.conf.set(c, size)
            df = s.read_fasta_chunks(spark, str(tmp_path), 20, 5)
            assert sorted(map(tuple, df.collect())) == sorted(want)
            assert "Window" not in plan(df)
    finally:
        for c, x in keep.items():
            spark.conf.set(c, x)


def test_spans_meet_one_chunk(spark):
    seqs = spark.createDataFrame([(1, "ACGT" * 150), (2, "N" * 300)], "doc_id long, seq string")
    spans = spark.createDataFrame([("a", 1, 190, 270), ("b", 1, 199, 201), ("c", 1, 590, 600), ("d", 2, 5, 60), ("e", 1, 9, 9), ("a", 1, 400, 402)], "region_id string, doc_id long, from long, to long")
    df = q.cut_sequences(seqs, spans, 80)
    text = "ACGT" * 150
    assert sorted((r["region_id"], r["seq"]) for r in df.collect()) == sorted([("a", text[190:270]), ("b", text[199:201]), ("c", text[590:]), ("a", "AC")])
    assert "collect_list" not in plan(df) and "collect_list" not in plan(q.joi14(spark, SF))


def test_peaks_beside_sites(spark):
    assert "min_by" not in plan(q.joi8(spark, SF))


def test_single_blocks(spark):
    """One block alone is its own run, at any length; of two the longer one may be too long; tiles without beginnings leave before any run is looked for."""
    row = lambda name, start, stop: (name, 1000, 1099, "+", 7, "+", start, stop, 1010, 1010 + min(stop - start, 80))
    rows = [row(1, 140, 160), row(2, 140, 900), row(3, 100, 120), row(3, 3000, 3900)]
    df = spark.createDataFrame(rows, "name long, seg_start long, seg_end long, seg_strand string, chrom long, strand string, start long, stop long, ref_start long, ref_stop long")
    got = best_runs(df)
    assert {r["name"]: r["covered"] for r in got.collect()} == {1: 21, 2: 761, 3: 21}
    assert "exists(b" in plan(got)
