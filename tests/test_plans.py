"""What reaches the Parquet scan, and how often tables are read and shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import SMALL_DATA, queries
from stratalake.checks import compare, groups, rows
from stratalake.operators.reshape import unpivot
from stratalake.operators.union import union_relations
from stratalake.sources.files import load_table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned_columns(plan, marker):
    """Columns read by the scans whose schema mentions the marker."""
    schemas = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    return [sorted(re.sub(r"#\d+L?", "", c) for c in s.split(",")) for s in schemas if marker in s]


def test_mart_reads_only_what_it_needs(spark):
    plan = plan_of(queries()["mart_avg_lead_time"](spark, SMALL_DATA))
    assert sorted(scanned_columns(plan, "l_orderkey")) == [["l_orderkey", "l_partkey"], ["l_orderkey", "l_shipdate"]]
    assert scanned_columns(plan, "o_orderkey") == [["o_orderdate", "o_orderkey"]]


@pytest.mark.parametrize(
    "check, columns",
    [
        (lambda t: groups.unique(t, "l_orderkey"), ["l_orderkey"]),
        (lambda t: groups.not_constant(t, "l_suppkey", ["l_orderkey"]), ["l_orderkey", "l_suppkey"]),
        (lambda t: groups.recency(t, "l_shipdate", "day", 1), ["l_shipdate"]),
        (lambda t: rows.not_accepted_values(t, "l_returnflag", ["R"]), ["l_returnflag"]),
        (lambda t: rows.not_empty_string(t, "l_linestatus"), ["l_linestatus"]),
    ],
)
def test_checks_read_only_their_columns(spark, check, columns):
    plan = plan_of(check(load_table(spark, SMALL_DATA, "lineitem")))
    assert scanned_columns(plan, columns[0]) == [columns]


def test_row_checks_push_their_filter_to_the_scan(spark):
    plan = plan_of(rows.accepted_range(load_table(spark, SMALL_DATA, "orders"), "o_custkey", 5, 90))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "LessThan(o_custkey" in pushed and "GreaterThan(o_custkey" in pushed


def test_union_filters_every_branch_at_the_scan(spark):
    orders = load_table(spark, SMALL_DATA, "orders")
    union = union_relations([("a", orders), ("b", orders)], where="o_custkey = 3", include=["o_orderkey"])
    plan = plan_of(union)
    assert plan.count("EqualTo(o_custkey,3)") == 2
    assert scanned_columns(plan, "o_orderkey") == [["o_custkey", "o_orderkey"]] * 2


def test_unpivot_scans_once(spark):
    part = load_table(spark, SMALL_DATA, "part")
    plan = plan_of(unpivot(part, exclude=["p_partkey"], remove=["p_retailprice"]))
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_relationship_conditions_reach_both_scans(spark):
    lines, orders = (load_table(spark, SMALL_DATA, t) for t in ("lineitem", "orders"))
    plan = plan_of(
        compare.orphan_counts(
            lines, "l_orderkey", orders, "o_orderkey", "l_returnflag = 'R'", F.col("o_orderstatus") == "F"
        )
    )
    assert "EqualTo(l_returnflag,R)" in plan and "EqualTo(o_orderstatus,F)" in plan
