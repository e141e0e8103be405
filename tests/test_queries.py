"""Every registered query against its SQL in DuckDB, and the shape of the plans."""

import math

import duckdb
import pytest

from datasets import DATA
from skyledger.plans.catalogue import ORACLES, QUERIES
from skyledger.plans.lake import lake

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted(tuple(plain(v) for v in r) for r in df.select(*columns).collect())
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert rows == sorted(tuple(plain(r[i]) for i in places) for r in found.fetchall())


FITTED = {"m9_logistic_regression", "m10_random_forest", "m11_boosted_trees", "m13_linear_svm",
          "m15_m21_comparison", "m20_feature_strength", "m22_stored_year_scores", "s17_model_round_trip",
          "x1_positive_probability"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTED))
def test_plans_hold_no_cross_joins_or_row_functions(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


def plan_of(spark, name):
    return QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["s2_year_read", "s3_month_partition_read", "s4_pruned_year_read"])
def test_a_year_reads_its_own_folders(spark, name):
    plan = plan_of(spark, name)
    assert "flight_year_part" in plan.split("PartitionFilters: ")[1].split("]")[0]
    scan = plan.split("ReadSchema: ")[1]
    assert "ArrDelayMinutes" not in scan and "TailNumber" not in scan


DASHBOARDS = [n for n in QUERIES if n.startswith("d") and int(n[1:].split("_")[0]) <= 18]


@pytest.mark.parametrize("name", DASHBOARDS)
def test_dashboards_read_stored_rollups_only(spark, name):
    lake(spark, DATA).rollup_folder  # stored before, as by the aggregate job
    read = QUERIES[name](spark, DATA).inputFiles()
    assert read and all("/rollups-" in path and "/agg_" in path for path in read)
