"""Entropy of letter pairs against a plain count, with the pairs listed once a sequence."""

import math
from collections import Counter

from pyspark.sql import functions as F

from tidemark.functions import sequence as sq


def test_pair_entropy(spark):
    texts = ["", "A", "AA", "AAAAAA", "ACGT", "ACACACAC", "NNACGTTGCAAACCGTN", "ACGTACGGTTAACCNNTGCATGCATTGACCA", None]

    def plain(t):
        c = Counter(t[i : i + 2] for i in range(len(t) - 1))
        return -sum(n / (len(t) - 1) * math.log(n / (len(t) - 1), 16) for n in c.values())

    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", sq.pair_entropy(F.col("t")).alias("h"))
    for r in df.collect():
        assert abs(r["h"] - plain(r["t"] or "")) < 1e-12
    assert df._jdf.queryExecution().optimizedPlan().toString().count("substr") == 1
