"""The trimming chain: worked examples of every step, and that the view of the queries meets every branch."""

from pyspark.sql import functions as F

from tidemark.functions import trimming as tr
from tidemark.plans import views as v

FIVE, THREE = "TCTACAGTCCGAGC", "GATCACTGATGCATTG"
READ = "AACCGGTTAACCGGTTAA"


def test_steps():
    c = tr.Chain(five=FIVE, three=THREE)
    none = (None,) * 4
    assert c(FIVE + READ + THREE + "ACGT") == (READ, 1, 14, "full", 0, 33, 48, "full", 0)
    assert c("GG" + FIVE + READ) == (READ, 3, 16, "full", 0, *none)
    assert c(READ + THREE[:9] + "A" + THREE[10:]) == (READ, *none, 19, 34, "full", 1)
    assert c(READ + THREE[:5] + THREE[6:]) == (READ, *none, 19, 33, "full", 1)  # a gap: one letter less
    assert c(FIVE + FIVE + READ)[0] == READ  # the rightmost place
    assert c(READ + THREE + THREE)[0] == READ  # the leftmost place
    assert c(FIVE[-11:-6] + "A" + FIVE[-5:] + READ) == (READ, 1, 11, "inexact", 1, *none)
    assert c(READ + "GTTCACTGTTGC") == (READ, *none, 19, 30, "inexact", 2)  # two changes from ten letters on
    assert c(READ + "GTTCACTC")[7] != "inexact"  # eight letters bear one change only
    assert c(FIVE[-5:] + READ + THREE[:4]) == (READ, 1, 5, "exact", 0, 24, 27, "exact", 0)
    assert c(FIVE + "GAGC" + READ)[:5] == ("GAGC" + READ, 1, 14, "full", 0)  # no second step on a side that had the first
    assert c("") == ("", *none, *none) and c(FIVE) == ("", 1, 14, "full", 0, *none)
    assert tr.Chain(three=THREE)(FIVE + READ + THREE) == (FIVE + READ, *none, 33, 48, "full", 0)


def test_report(spark):
    rows = [(FIVE + READ + THREE, 1, 5), (FIVE + READ + THREE, 2, 1), (FIVE + READ + THREE + "A", 3, 2), (READ, 4, 3), (FIVE + READ, 5, 4), (FIVE + "A" * 20 + THREE, 6, 7), (FIVE + "AC" + THREE, 7, 1), (None, 8, 1)]
    tags = spark.createDataFrame(rows, "seq string, id long, n long").filter("seq is not null")
    out = tr.trimmed_tags(tags, tr.Chain(five=FIVE, three=THREE), least_five=1, least_three=3)
    got = {r["counter"]: (r["n"], r["percent"]) for r in tr.trimming_report(out).collect()}
    assert got["input"] == (23, 100.0) and got["unique_input"][0] == 6 and got["five_full"][0] == 20 and got["three_full"][0] == 16 and got["five_any"][0] == 20
    assert got["five_short"][0] == 3 and got["three_short"][0] == 4 and got["unique_output"][0] == 5
    assert got["passed"][0] == 8 and got["low_entropy"][0] == 7 and got["too_short"][0] == 1 and got["too_many_n"][0] == 0
    assert [(r["seq"], r["n"], r["id"]) for r in tr.cleaned_tags(out).filter("code = 0").collect()] == [(READ, 8, 1)]


def test_view_meets_every_branch(spark):
    out = tr.trimmed_tags(v.tagged(spark, "/root/testdata/sf0.001"), tr.Chain(five=v.FIVE, three=v.ADAPTOR), least_five=1, least_three=3)
    kinds = {(r["f"], r["t"]) for r in out.select(F.coalesce("five_kind", F.lit("none")).alias("f"), F.coalesce("three_kind", F.lit("none")).alias("t")).distinct().collect()}
    assert kinds == {(f, t) for f in ("full", "inexact", "exact", "none") for t in ("full", "inexact", "exact", "none")}
    assert {r["fate"] for r in out.select("fate").distinct().collect()} == {"five_short", "three_short", "cleaned"}
