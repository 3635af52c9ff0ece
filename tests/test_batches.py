"""Functions that work on batches of reads: the same as the plain ones, a read at a time."""

import random

from pyspark.sql import functions as F

from tidemark.functions import sequence as sq


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_entropies(spark, monkeypatch):
    r = random.Random(3)
    texts = ["", "A", "AA", "NNACGTTGCAAACCGTN", "\u00e9\U0001f600A\U0001f600A", None, *("".join(r.choice("ACGTN") for _ in range(r.randrange(60))) for _ in range(200))]
    monkeypatch.setattr(sq, "CELLS", 97)
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(sq.pair_entropies(F.col("t")).alias("a"), sq.pair_entropy(F.col("t")).alias("b"))
    assert all(abs(x["a"] - x["b"]) < 1e-12 for x in df.collect())
    assert "lambda" not in _plan(df.select("a"))


def test_quality_is_scored_once_a_code(spark):
    r = random.Random(4)
    rows = [(k, "ACGTN" * 12, "".join(chr(33 + r.randrange(41)) for _ in range(r.randrange(60)))) for k in range(300)] + [(301, "ACGT", None), (302, "A", "")]
    df = sq.quality_trim(spark.createDataFrame(rows, "id long, seq string, qual string"), sq.solexa_to_phred, least=3, most_n=20)
    table = {x["q"]: x["s"] for x in spark.range(42).select(F.col("id").cast("int").alias("q")).select("q", sq.solexa_to_phred(F.col("q")).alias("s")).collect()}
    want = {}
    for k, seq, qual in rows:
        total, keep = 0.0, 0
        for i, c in enumerate(qual or "", 1):
            total += table[ord(c) - 33]
            keep = i if total >= 20.0 * i else keep
        if keep >= 3:
            want[k] = (seq[:keep], qual[:keep])
    assert want and {x["id"]: (x["trimmed"], x["tq"]) for x in df.collect()} == want
    assert "lambda" not in _plan(df) and _plan(df).count("EvalPython") == 1


def test_outermost_form(spark):
    """The adaptor's halves lose no form of it: all texts against a search without them."""
    r = random.Random(5)
    for five in (False, True):
        known = sq.changes("GATCACTG", 1, True, five, "A")
        held = sq.pieces(known, "GATCACTG")
        assert held == ("GATC", "ACT")
        for _ in range(3000):
            text = "".join(r.choice("ACGT") for _ in range(r.randrange(6))) + r.choice(sorted(known)) + "".join(r.choice("ACGT") for _ in range(r.randrange(6)))
            text = text[r.randrange(3) :]
            assert sq.outermost(text, known, held, 8, five) == sq.outermost(text, known, ("",), 8, five)
    assert sq.pieces(sq.changes("GATCACTG", 2), "GATCACTG") == ("",)
    df = spark.createDataFrame([("TTGATCACTGAA",), (None,), ("GATC",)], "s string").select(sq.trim_full(F.col("s"), "GATCACTG", 1).alias("x"), sq.trim_full(F.col("s"), "GATCACTG", 1, five=True).alias("y"))
    assert [tuple(x) for x in df.collect()] == [("TT", "AA"), (None, None), ("GATC", "GATC")] and "lambda" not in _plan(df)


def test_descriptions(spark):
    df = spark.createDataFrame([("AC-TTA", "ACGT-C"), ("AAAA", "AAAA"), ("--", "AC"), (None, "A"), ("", "")], "q string, t string")
    out = df.select("q", "t", sq.describe(F.col("q"), F.col("t")).alias("d"))
    out = out.select("q", "d", sq.restore(F.translate("t", "-", ""), F.col("d")).alias("r"))
    got = [(x["d"], x["r"]) for x in out.collect()]
    assert got == [("2M DG 1M IT A", "ACTTA"), ("4M", "AAAA"), ("DA DC", ""), (None, None), ("", "")]
    assert "lambda" not in _plan(out)
