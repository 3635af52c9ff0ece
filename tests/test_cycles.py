"""Differences by cycle, summed within batches, against a plain loop."""

from collections import defaultdict

import pytest

from tidemark.plans import q_reads as r

HITS = [(0, 2, 3, "ACGTN", "ACCTNA"), (0, 1, 1, "ACGTN", "AC"), (1, 5, 2, "A", "C"), (1, 5, 2, "", "C"), (0, 2, 3, "ACGTN", "ACGTN"), (1, 1, 4, None, "A")]


@pytest.mark.parametrize("dense", [r.DENSE, 0])
def test_cycles(spark, dense, monkeypatch):
    """Reads of several lengths, targets that end early or late, empty and null reads; no row a letter leaves the batch."""
    monkeypatch.setattr(r, "DENSE", dense)
    want = defaultdict(float)
    for sample, n, k, q, t in HITS * 50:
        errors = 0
        for i, x in enumerate(q or ""):
            bad = int(x != t[i : i + 1])
            errors += bad
            want[sample, i + 1, bad, errors] += n / k
    df = spark.createDataFrame(HITS * 50, "sample long, n long, k long, q string, t string")
    out = r.cycles(df)
    got = {tuple(row[:4]): row["w"] for row in out.select("sample", "cycle", "bad", "errors", "w").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()
