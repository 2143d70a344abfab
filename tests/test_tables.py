"""Versions of tables, zone maps and catalog tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from stratalake.checks import bitmaps, compare, groups, runner
from stratalake.plans.layered_run import ChecksFailed, run_layers, table_checks
from stratalake.session import scratch_path
from stratalake.sources import layers, zones
from stratalake.sources.sales import sales_sources

DATA = "/root/testdata/sf0.001"


def test_a_write_that_fails_leaves_the_table(spark, rows_of):
    path = scratch_path(spark, "versions")
    layers.write_table(spark.range(3), path)
    failing = spark.range(0, 8, 1, 4).select(F.when(F.col("id") == 7, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(PySparkException, match="killed"):
        layers.write_table(failing, path)
    assert rows_of(spark.read.parquet(layers.current_version(spark, path))) == [(0,), (1,), (2,)]
    layers.write_table(spark.range(5), path)
    assert spark.read.parquet(layers.current_version(spark, path)).count() == 5


def test_a_reader_that_has_begun_goes_on(spark):
    path = scratch_path(spark, "versions")
    first = layers.materialize(spark.range(3), path)
    second = layers.materialize(spark.range(4), path)
    assert (first.count(), second.count()) == (3, 4)
    unfinished = layers.new_version(spark.range(9), path)
    layers.materialize(spark.range(5), path)
    assert second.count() == 4 and spark.read.parquet(unfinished).count() == 9
    with pytest.raises(PySparkException):
        spark.read.parquet(first.inputFiles()[0]).count()


def test_tables_of_a_layer_switch_after_its_checks(spark):
    root, sources = scratch_path(spark, "run"), sales_sources(spark, DATA)
    run_layers(sources, root, lambda tables: {}, layers=["bronze"])
    before = layers.read_layer(spark, root, "bronze", "raw_products")
    files = sorted(before.inputFiles())

    def strict(tables):
        return {**table_checks(tables), "raw_products": [runner.accepted_range("ProductID", max_value=-1, severity="error")]}

    with pytest.raises(ChecksFailed):
        run_layers(sources, root, strict, layers=["bronze"])
    assert sorted(layers.read_layer(spark, root, "bronze", "raw_products").inputFiles()) == files


def test_catalog_table_is_pointed_at_the_new_version(spark, rows_of):
    saved = layers.save_as_table(spark.range(3), "versions_db", "t")
    assert saved.count() == 3
    failing = spark.range(2).select(F.raise_error(F.lit("killed")).cast("bigint").alias("id"))
    with pytest.raises(PySparkException, match="killed"):
        layers.save_as_table(failing, "versions_db", "t")
    assert spark.table("versions_db.t").count() == 3
    layers.save_as_table(spark.range(4), "versions_db", "t")
    view = layers.persistent_view(spark, "versions_db", "v", "SELECT max(id) AS last FROM versions_db.t")
    assert rows_of(view) == [(3,)]
    layers.save_as_table(spark.range(9), "versions_db", "t")
    assert rows_of(spark.newSession().table("versions_db.v")) == [(8,)]
    layers.save_as_table(spark.range(2).selectExpr("id", "'x' AS more"), "versions_db", "t")
    assert spark.table("versions_db.t").columns == ["id", "more"]


@pytest.mark.parametrize("key", ["id", "text", "hot"])
def test_zone_map_chooses_files(spark, rows_of, key):
    rows = spark.range(0, 20_000, 1, 4).select(
        "id",
        F.format_string("k%06d", F.col("id") * 7 % 20_000).alias("text"),
        F.when(F.col("id") % 4 == 0, 5_000).when(F.col("id") % 4 == 1, None).otherwise(F.col("id")).alias("hot"),
    )
    path = scratch_path(spark, "zones")
    laid_out = layers.clustered(rows, [key], n_files=16)
    laid_out.write.parquet(path)
    zone_rows = zones.write_zone_map(spark, path, key)
    assert zone_rows.agg(F.sum("n_rows")).first()[0] == 20_000
    assert zones.overlapping_files(zone_rows).count() == 0
    low, high = {"id": (300, 900), "text": ("k000300", "k000900"), "hot": (300, 900)}[key]
    chosen = zones.read_range(spark, path, key, low, high)
    assert len(chosen.inputFiles()) <= 3 < zone_rows.count()
    assert rows_of(chosen) == rows_of(rows.filter(F.col(key).between(low, high)))
    assert zones.read_range(spark, path, key, high=low).count() == rows.filter(F.col(key) <= low).count()
    assert zones.read_range(spark, path, key, low).count() == rows.filter(F.col(key) >= low).count()
    nothing = zones.read_range(spark, path, key, "zzz" if key == "text" else 10**9)
    assert nothing.count() == 0 and nothing.dtypes == rows.dtypes


def test_files_that_overlap_are_found(spark, rows_of):
    zone_rows = spark.createDataFrame(
        [("a", 5, 1, 10), ("b", 5, 10, 20), ("c", 5, 19, 30), ("d", 5, None, None)], "file string, n_rows long, least int, greatest int"
    )
    assert rows_of(zones.overlapping_files(zone_rows)) == [("b", 5, 10, 20, 19)]


def test_bucketed_tables_join_and_aggregate_as_they_lie(spark, rows_of):
    orders = spark.range(0, 5_000, 1, 4).select(F.col("id").alias("order_id"), (F.col("id") * 2).alias("v"))
    lines = spark.range(0, 20_000, 1, 4).select((F.col("id") % 5_003).alias("order_id"), "id")
    saved = [layers.save_bucketed(df, "bucket_db", name, "order_id", 4) for name, df in (("orders", orders), ("lines", lines))]
    joined = saved[1].hint("merge").join(saved[0], "order_id", "left")
    unique = groups.unique(saved[0], "order_id")
    for df in (joined, unique):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange " not in plan and "Bucketed: true" in plan
    assert rows_of(joined) == rows_of(lines.join(orders, "order_id", "left")) and unique.count() == 0


def test_bucketed_table_is_replaced_in_one_step(spark):
    rows = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    layers.save_bucketed(rows, "bucket_db", "t", "k", 4)
    failing = rows.withColumn("v", F.when(F.col("k") == 9, F.raise_error(F.lit("killed"))).otherwise(F.col("v")))
    with pytest.raises(PySparkException, match="killed"):
        layers.save_bucketed(failing, "bucket_db", "t", "k", 4)
    assert spark.table("bucket_db.t").count() == 10
    layers.save_bucketed(rows.limit(3), "bucket_db", "t", "k", 4)
    assert spark.table("bucket_db.t").count() == 3 and layers._buckets_of(spark, "bucket_db.t") == ("k", 4)
    layers.save_bucketed(rows.withColumn("w", F.lit(1)), "bucket_db", "t", "k", 3)
    assert spark.table("bucket_db.t").columns == ["k", "v", "w"] and layers._buckets_of(spark, "bucket_db.t") == ("k", 3)


def key_rows(spark):
    """Repeated, missing, negative and hot keys, and rows without one."""
    key = "CASE WHEN id % 3 = 0 THEN 40000 WHEN id % 50 = 1 THEN NULL WHEN id % 7 = 2 THEN -id ELSE id END"
    children = spark.range(0, 30_000, 1, 4).selectExpr(f"{key} AS k", "id % 2 AS side", "id")
    parents = spark.range(-20_000, 100_000, 1, 4).selectExpr("IF(id % 11 = 0, NULL, id) AS p", "id % 5 AS kind")
    return children, parents


def test_bitmaps_say_what_rows_say(spark, rows_of):
    children, parents = key_rows(spark)
    assert rows_of(bitmaps.unique(children, "k")) == rows_of(groups.unique(children, "k"))
    conditions = {"from_condition": "side = 1", "to_condition": "kind <> 3"}
    found = bitmaps.orphan_counts(children, "k", parents, "p", **conditions)
    assert rows_of(found) == rows_of(compare.orphan_counts(children, "k", parents, "p", **conditions)) and found.count() > 100
    assert rows_of(bitmaps.distinct_keys(children, "k")) == rows_of(children.selectExpr("count(k)", "count(DISTINCT k)"))
    assert bitmaps.orphan_counts(parents.filter("p > 0"), "p", parents, "p").count() == 0
    none = children.limit(0)
    assert bitmaps.unique(none, "k").count() == 0 and rows_of(bitmaps.distinct_keys(none, "k")) == [(0, 0)]


def test_bitmaps_are_what_is_shuffled(spark):
    plan = bitmaps.distinct_keys(spark.range(10**6), "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan and plan.count("Exchange ") == 2


def test_tables_are_reconciled_by_sums(spark, rows_of):
    a = spark.range(0, 5_000, 1, 4).selectExpr("id AS k", "IF(id % 9 = 0, NULL, id % 4) AS x", "IF(id % 9 = 0, id % 4, NULL) AS y")
    changed = a.selectExpr("k", "IF(k = 1234, 77, x) AS x", "y").unionAll(spark.sql("SELECT 9999L, 1L, NULL"))
    swapped = a.selectExpr("k", "IF(k = 18, y, x) AS x", "IF(k = 18, x, y) AS y")
    for other in (a.repartition(3), changed, swapped, a.unionAll(a.limit(5)), a.limit(0)):
        for n_buckets in (1, 65_536):
            assert rows_of(compare.reconcile(a, other, n_buckets=n_buckets)) == rows_of(compare.equality(a, other))
    only_some = compare.reconcile(a, changed)._jdf.queryExecution().analyzed().toString()
    assert "LeftSemi" in only_some


def test_key_checks_of_a_table_share_one_scan(spark, rows_of):
    children, parents = key_rows(spark)
    path, parent_path = scratch_path(spark, "children"), scratch_path(spark, "parents")
    children.write.parquet(path)
    parents.write.parquet(parent_path)
    children, parents = spark.read.parquet(path), spark.read.parquet(parent_path)
    checks = [
        *runner.primary_key("k"),
        runner.unique("id"),
        runner.unique("k", where="side = 1").configured(name="unique on one side"),
        runner.accepted_range("k", min_value=0, where="side = 0"),
        runner.relationships("k", parents, "p"),
        runner.relationships("k", parents, "p", "side = 1", "kind <> 3").configured(name="some of them", severity="error"),
    ]
    report = runner.run_checks(children, checks)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 3  # the table, and the parents of two checks
    apart = {c.name: c.violations(children).agg(F.expr(c.failures).alias("n")).first().n or 0 for c in checks}
    assert {r.check_name: r.failures for r in report.collect()} == apart and all(v > 0 for k, v in apart.items() if k != "unique_id")
    assert {r.check_name: r.status for r in report.collect()}["some of them"] == "fail"
    nothing = runner.run_checks(children.limit(0), checks)
    assert {r.failures for r in nothing.collect()} == {0}


def test_a_check_with_another_query_shares_no_scan(spark):
    check = runner.unique("id").configured(query=lambda df: df.filter("id = 1"))
    assert check.key is None and runner.run_checks(spark.range(5), [check]).first().failures == 1
