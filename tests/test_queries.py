"""Registry shape, and a spread of queries against their SQL at the smallest scale."""

import duckdb
import pytest

from check import TABLES, frames_differ

FOLDER = "/root/testdata/sf0.001"
CHECKED = [
    "woe_table", "iv_summary", "model_metrics", "ks_table", "lift_table", "psi_detail", "feature_monitor", "group_statistics",
    "target_encoding_out_of_fold", "decision_engine", "count_before", "trailing_apply_count", "repayment_sequences", "rank_blend",
    "connected_components", "csv_round_trip", "stream_trailing_counts",
]


@pytest.fixture(scope="module")
def registry():
    import __spark_entry__ as entry

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return entry.queries(), entry.oracle_sql(), con


def test_every_check_has_its_query(registry):
    qs, sqls, _ = registry
    assert set(sqls) <= set(qs)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, registry, name):
    qs, sqls, con = registry
    assert frames_differ(qs[name](spark, FOLDER).toPandas(), con.execute(sqls[name]).df()) is None


def test_filters_and_columns_reach_the_scan(spark, registry):
    plan = registry[0]["vintage"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "l_comment" not in plan and "ReadSchema" in plan
    late = registry[0]["modelling_sample"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "l_extendedprice" not in late.split("Physical Plan")[1]


def test_global_prefix_sums_use_no_single_partition(spark):
    from loanloom.operators.ordering import prefix_sums

    df = spark.range(1000).selectExpr("id", "CAST(id % 97 AS DOUBLE) AS v", "1 AS n")
    plan = prefix_sums(df, "v", ["n"], cuts=[10.0, 50.0])._jdf.queryExecution().executedPlan().toString()
    # the only single-partition exchange orders the slice totals, never the histogram
    assert plan.count("Exchange SinglePartition") <= 1
