"""Order, choice and restart of models; the catalog; positions."""

import pytest
from pyspark.sql import functions as F

from stratalake.checks import runner
from stratalake.operators import introspect
from stratalake.operators.ordered import numbered
from stratalake.plans.graph import Model, ModelGraph, RunFailed
from stratalake.plans.layered_run import SALES, build_layers, publish_catalog
from stratalake.session import scratch_path
from stratalake.sources.layers import read_layer
from stratalake.sources.sales import sales_sources

DATA = "/root/testdata/sf0.001"


def graph_of(counts, broken=()):
    """a -> b -> d, a -> c -> d, and e alone; counts how often each is built."""

    def model(name, *inputs):
        def build(*tables):
            counts[name] = counts.get(name, 0) + 1
            table = tables[0].withColumn(name, F.lit(1))
            return table.filter(F.raise_error(F.lit("broken")).isNull()) if name in broken else table

        return Model(name, "one", inputs, build, ("id",))

    return ModelGraph([model("d", "b", "c"), model("b", "a"), model("c", "a"), model("a", "src"), model("e", "src")])


def test_order_and_choice():
    graph = graph_of({})
    assert graph.order == ["a", "e", "b", "c", "d"] and graph.sources == ["src"]
    assert graph.select() == graph.order
    assert graph.select("+b") == ["a", "b"] and graph.select("c+") == ["c", "d"] and graph.select("+c+") == ["a", "c", "d"]
    assert graph.select("e", "b") == ["e", "b"] and graph.select("layer:one") == graph.order
    for wrong in ("x", "layer:two"):
        with pytest.raises(ValueError):
            graph.select(wrong)


def test_circles_and_repeated_names_are_refused():
    build = lambda *tables: tables[0]
    with pytest.raises(ValueError, match="a -> b -> a"):
        ModelGraph([Model("a", "x", ("b",), build), Model("b", "x", ("a",), build)])
    with pytest.raises(ValueError, match="twice"):
        ModelGraph([Model("a", "x", (), build)] * 2)


def test_a_failed_run_goes_on_from_the_failed_model(spark):
    root, counts, sources = scratch_path(spark, "graph"), {}, {"src": spark.range(5)}
    with pytest.raises(RunFailed, match="broken") as failure:
        graph_of(counts, broken={"c"}).run(sources, root)
    states = {r.model: r.state for r in failure.value.states.collect()}
    assert states == {"a": "done", "e": "done", "b": "done", "c": "failed", "d": "skipped"}
    assert read_layer(spark, root, "one", "b").count() == 5
    counts.clear()
    tables = graph_of(counts).run(sources, root, resume=True)
    assert counts == {"c": 1, "d": 1} and list(tables) == ["a", "e", "b", "c", "d"]
    assert tables["d"].columns == ["id", "a", "b", "d"] and tables["d"].count() == 5
    assert {r.state for r in read_layer(spark, root, "runs", "states").collect()} == {"done"}


def test_a_choice_reads_what_it_is_built_from(spark):
    root, counts, sources = scratch_path(spark, "graph"), {}, {"src": spark.range(5)}
    graph = graph_of(counts)
    graph.run(sources, root)
    counts.clear()
    assert graph.run({"src": spark.range(9)}, root, ["d"])["d"].count() == 5 and counts == {"d": 1}


def test_a_failed_check_keeps_the_earlier_version(spark):
    root, sources = scratch_path(spark, "graph"), {"src": spark.range(5)}
    graph = graph_of({})
    graph.run(sources, root)
    checks = lambda tables: {"b": [runner.accepted_range("id", max_value=6, severity="error")]}
    with pytest.raises(RunFailed, match="accepted_range_id found 2"):
        graph.run({"src": spark.range(9)}, root, checks=checks)
    assert (read_layer(spark, root, "one", "b").count(), read_layer(spark, root, "one", "c").count()) == (5, 9)


def test_sales_models_in_order():
    layers = [SALES.models[n].layer for n in SALES.order]
    assert layers == ["bronze"] * 3 + ["silver"] * 3 + ["gold"] * 2 + ["datamart"] * 2
    assert set(SALES.sources) == {"src_products", "src_sales_order_header", "src_sales_order_detail"}


def test_marts_of_the_catalog_follow_their_tables(spark):
    sources = sales_sources(spark, DATA)
    names = publish_catalog(sources, "graph_test_")
    before = spark.newSession().table(names["avg_lead_time_prod_category"]).count()
    none = {name: table.limit(0) for name, table in sources.items()}
    publish_catalog(none, "graph_test_")
    after = spark.newSession()
    assert before > 0 and [after.table(n).count() for n in names.values()] == [0, 0]
    assert set(build_layers(sources)) == {n for n in SALES.order if not SALES.models[n].is_view}


@pytest.mark.parametrize("n_ranges", [1, 7])
def test_rows_are_numbered_in_order(spark, rows_of, n_ranges):
    rows = spark.range(0, 1_000, 1, 3).select((F.col("id") * 7 % 1_000).alias("v"), (F.col("id") % 4).alias("tie"))
    found = numbered(rows, ["tie"], "n", n_ranges)
    in_order = sorted((r.tie, r.v) for r in rows.collect())
    assert rows_of(found) == [(v, tie, n) for n, (tie, v) in enumerate(in_order)]
    assert numbered(rows.limit(0), ["tie"], "n").count() == 0


def test_results_in_columns_and_pages(table, rows_of):
    df = table("a int, b string", (2, None), (1, "x"), (None, "y"))
    assert rows_of(introspect.results_in_columns(df, ["a"])) == [
        ("a", 0, None), ("b", 0, "y"), ("a", 1, "1"), ("b", 1, "x"), ("a", 2, "2"), ("b", 2, None)
    ]
    assert [tuple(r) for r in introspect.page(df, ["a"], 1, 5)] == [(1, "x"), (2, None)]


def test_lists_that_are_too_long_for_the_driver_raise(spark):
    with pytest.raises(ValueError, match="more than 3 rows"):
        introspect.column_value_list(spark.range(4), "id", max_rows=3)
    assert len(introspect.column_value_list(spark.range(4), "id", max_rows=4)) == 4
