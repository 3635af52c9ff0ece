"""Every query with SQL gives DuckDB's rows; overlap and cutoff plans have no nested loop."""

import duckdb
import pytest

from tidemark.plans import load
from tidemark.plans.registry import ORACLE_SQL, QUERIES

load()
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(x):
    return 0.0 if isinstance(x, float) and x == 0 else x


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    mine = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in ORACLE_SQL:
        assert len(set(df.columns)) == len(df.columns)
        return
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert mine == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)


@pytest.mark.parametrize("name", ["joi1_overlap_join", "joi2_min_overlap_stranded", "joi3_subtract_intervals", "joi4_repeat_anti_join", "joi5_strand_cross_correlation", "joi7_three_nearest_each_side"])
def test_no_nested_loops(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
