"""Every query with a check statement against DuckDB, and plan properties."""

import re

import duckdb
import pytest

import check_queries
from ladle.operators import cleaning
from ladle.plans.registry import load_all

QUERIES = load_all()
CHECKED = sorted(n for n, q in QUERIES.items() if q.sql)


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in check_queries.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, mart, con, sf_dir, name):
    q = QUERIES[name]
    _, _, verdict = check_queries.compare(spark, con, sf_dir, name, lambda s, d: q.run(mart), q.sql)
    assert verdict.startswith("ok") and "TYPES" not in verdict, verdict


def test_entry_contract(spark):
    import __spark_entry__ as contract
    assert set(contract.oracle_sql()) <= set(contract.queries())
    df = contract.entry(spark)
    assert df.count() > 0 and {"item_id", "location_id", "local_class"} <= set(df.columns)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHECKED)
def test_plans_stay_in_the_jvm_and_have_no_keyless_join(mart, name):
    plan = plan_of(QUERIES[name].run(mart))
    for node in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, f"{name}: {node}"


def test_small_dimensions_are_broadcast_and_large_ones_are_not(spark, mart):
    fact = mart.lazy_fact()
    assert "BroadcastHashJoin" in plan_of(fact)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(mart.lazy_fact())
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(mart):
    plan = plan_of(mart.fact.filter("location_id = 3 and order_date >= '1997-01-01'").select("revenue"))
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert re.search(r"PartitionFilters: \[.*location_id.* = 3", scan)
    assert "PushedFilters: [IsNotNull(order_date), GreaterThanOrEqual(order_date" in scan
    assert scan.split("ReadSchema:")[1].strip() == "struct<order_date:date,revenue:decimal(18,2)>"


def test_duplicates_are_combined_before_the_shuffle(mart):
    plan = plan_of(cleaning.drop_duplicate_lines(mart.raw_lines))
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan


def test_invariants(mart):
    assert mart.fact.filter("profit > revenue").count() == 0
    assert mart.fact.count() <= mart.clean_lines.count()
    assert mart.fact.agg({"revenue": "sum"}).first()[0] == mart.orders.agg({"revenue": "sum"}).first()[0]
    assert mart.order_items.agg({"lines": "sum"}).first()[0] == mart.fact.count()
    assert mart.priced_lines().count() == mart.price_probes.count()
    assert {r.k for r in mart.menu.selectExpr("menu_class as k").collect()} <= {
        "Profit Driver", "Volume Driver", "Hidden Opportunity", "Low Performer"}
