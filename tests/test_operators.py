import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratalake.functions.dates import add_part
from stratalake.operators import introspect
from stratalake.operators.counted import expand_counts
from stratalake.operators.dedupe import deduplicate
from stratalake.operators.project import filtered_columns, group_by_n, nullcheck, nullcheck_table, star
from stratalake.operators.reshape import pivot, pivot_columns, unpivot
from stratalake.operators.series import date_spine, generate_series
from stratalake.operators.union import union_relations
from stratalake.sources.catalog import (
    Relation,
    open_relations,
    relations_by_pattern,
    relations_by_prefix,
    tables_by_prefix,
)
from stratalake.sources.layers import save_as_table


# --- deduplicate


def test_deduplicate_keeps_the_first_full_row(table, rows_of):
    df = table("user_id int, event string, version int", (1, "play", 1), (1, "play", 2), (2, "pause", 1))
    kept = deduplicate(df.filter("user_id = 1"), ["user_id"], [F.col("version").desc()])
    assert rows_of(kept) == [(1, "play", 2)]


def test_deduplicate_treats_null_keys_as_one_group(table, rows_of):
    df = table("k int, v string", (None, "b"), (None, "a"), (1, None), (1, "z"))
    assert rows_of(deduplicate(df, ["k"], [F.col("v").asc_nulls_last()])) == [(1, "z"), (None, "a")]


def test_deduplicate_drops_rows_before_the_shuffle(table):
    plan = (
        deduplicate(table("k int, v int", (1, 2)), ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    )
    assert plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


# --- union


@pytest.fixture
def two_tables(table):
    one = table("id int, name string, favorite_number string", (1, "drew", "pi"), (2, "bob", "e"), (3, "alice", "4"))
    two = table("id int, favorite_color string, favorite_number int", (1, "green", 7), (2, "pink", 13))
    return [("t1", one), ("t2", two)]


def test_union_has_all_columns_in_order_of_appearance(two_tables, rows_of):
    union = union_relations(two_tables)
    assert union.columns == ["_dbt_source_relation", "id", "name", "favorite_number", "favorite_color"]
    assert union.schema["favorite_number"].dataType.simpleString() == "string"
    assert rows_of(union) == [
        ("t1", 1, "drew", "pi", None),
        ("t1", 2, "bob", "e", None),
        ("t1", 3, "alice", "4", None),
        ("t2", 1, None, "7", "green"),
        ("t2", 2, None, "13", "pink"),
    ]


@pytest.mark.parametrize("spelling", ["name", "NAME"])
def test_union_exclude_and_include(two_tables, spelling):
    assert "name" not in union_relations(two_tables, exclude=[spelling]).columns
    assert union_relations(two_tables, include=[spelling], source_column_name=None).columns == ["name"]


def test_union_where_filters_each_branch(two_tables, rows_of):
    union = union_relations(two_tables, where="id = 1", source_column_name=None)
    assert rows_of(union) == [(1, None, "7", "green"), (1, "drew", "pi", None)]


def test_union_override_and_first_holder_types(two_tables, table):
    union = union_relations(two_tables, column_override={"ID": "bigint"})
    assert union.schema["id"].dataType.simpleString() == "bigint"
    ints_first = union_relations([("a", table("x int", 1)), ("b", table("X string", "2"))])
    assert ints_first.schema["x"].dataType.simpleString() == "int"
    assert [row.x for row in ints_first.orderBy("x").collect()] == [1, 2]


def test_union_errors(two_tables):
    with pytest.raises(ValueError, match="not both"):
        union_relations(two_tables, include=["id"], exclude=["name"])
    with pytest.raises(ValueError, match="no columns"):
        union_relations(two_tables, include=["missing"])
    with pytest.raises(ValueError):
        union_relations([])


# --- pivot and unpivot


@pytest.fixture
def shirts(table):
    return table("size string, color string", ("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red"))


def test_pivot(shirts, rows_of):
    assert rows_of(pivot(shirts, ["size"], "color", ["red", "blue"])) == [("M", 1, 0), ("S", 1, 1)]


def test_pivot_with_an_apostrophe_and_slug_names(shirts, rows_of):
    result = pivot(shirts, ["size"], "color", ["red", "blue's"], quote_identifiers=False)
    assert result.columns == ["size", "red", "blues"]
    assert rows_of(result) == [("M", 1, 0), ("S", 1, 1)]


def test_pivot_options(table, rows_of):
    df = table("k int, x int, y int", (1, 1, 10), (1, 5, 10), (1, 9, 20), (2, 1, None))
    above = pivot(df, ["k"], "x", [1, 5], cmp=">", then_value="y", prefix="over_", suffix="_x")
    assert above.columns == ["k", "over_1_x", "over_5_x"]
    assert rows_of(above) == [(1, 30, 20), (2, 0, 0)]
    distinct = pivot(df, ["k"], "x", [0], agg="count", cmp=">", then_value="y", else_value=None, distinct=True)
    assert rows_of(distinct) == [(1, 2), (2, 0)]
    per_value = pivot(df, ["k"], "x", [1, 5, 9], agg="count", then_value="y", else_value=None, distinct=True)
    assert rows_of(per_value) == [(1, 1, 1, 1), (2, 0, 0, 0)]
    assert "Expand" not in per_value._jdf.queryExecution().executedPlan().toString()
    largest = pivot(df, ["k"], "x", [0], agg="max", cmp=">", then_value="y")
    assert rows_of(largest) == [(1, 20), (2, None)]
    assert len(pivot_columns("x", [1, 2], alias=False)) == 2
    with pytest.raises(ValueError):
        pivot_columns("x", [1], cmp="~")


@pytest.fixture
def customers(table):
    return table(
        "customer_id int, created_at string, status string, segment string, name string",
        (123, "2017-01-01", "active", "tier 1", "name 1"),
        (234, "2017-02-01", "active", "tier 3", "name 3"),
        (567, "2017-03-01", "churned", None, "name 2"),
    )


def test_unpivot(customers, rows_of):
    long = unpivot(
        customers, exclude=["customer_id", "created_at"], remove=["NAME"], field_name="prop", value_name="val"
    )
    assert long.columns == ["customer_id", "created_at", "prop", "val"]
    assert rows_of(long) == [
        (123, "2017-01-01", "segment", "tier 1"),
        (123, "2017-01-01", "status", "active"),
        (234, "2017-02-01", "segment", "tier 3"),
        (234, "2017-02-01", "status", "active"),
        (567, "2017-03-01", "segment", None),
        (567, "2017-03-01", "status", "churned"),
    ]


def test_unpivot_defaults(customers):
    long = unpivot(customers, exclude=["customer_id", "created_at"])
    assert long.columns == ["customer_id", "created_at", "field_name", "value"] and long.count() == 9


def test_unpivot_booleans_and_casts(table, rows_of):
    df = table("id int, flag boolean, n int", (1, True, 5), (2, False, 6), (3, None, 7))
    assert rows_of(unpivot(df, exclude=["ID"], remove=["n"])) == [
        (1, "flag", "true"),
        (2, "flag", "false"),
        (3, "flag", None),
    ]
    assert rows_of(unpivot(df, "bigint", exclude=["id"], remove=["flag"])) == [(1, "n", 5), (2, "n", 6), (3, "n", 7)]


def test_unpivot_errors(customers):
    with pytest.raises(ValueError):
        unpivot(None)
    with pytest.raises(ValueError):
        unpivot(customers, exclude=customers.columns)


# --- column lists


def test_star(table, rows_of):
    df = table("field_1 string, field_2 string, field_3 string", ("a", "b", "c"), ("d", "e", "f"))
    for spelling in ("field_3", "FIELD_3"):
        assert rows_of(df.select(*star(df, [spelling]))) == [("a", "b"), ("d", "e")]
    renamed = df.alias("r").select(*star(df, ["field_1"], "prefix_", "_suffix", relation_alias="r"))
    assert renamed.columns == ["prefix_field_2_suffix", "prefix_field_3_suffix"]
    assert star(df, df.columns) == []
    assert df.select(*star(df, quote_identifiers=False)).columns == df.columns
    assert filtered_columns(df, ["FIELD_1"]) == ["field_2", "field_3"]


def test_star_in_a_grouping(table, rows_of):
    df = table("g1 string, g2 string, v int", ("a", "b", 1), ("a", "b", 2), ("c", "d", 3), ("c", "e", 4))
    assert rows_of(df.groupBy(*star(df, ["v"])).agg(F.sum("v"))) == [("a", "b", 3), ("c", "d", 3), ("c", "e", 4)]


def test_nullcheck(table, rows_of):
    df = table("a string, b string, c int", ("", "x", 1), ("y", "", 2))
    assert rows_of(nullcheck_table(df)) == [("y", None, 2), (None, "x", 1)]
    assert df.select(*nullcheck(df, ["A", "c"])).columns == ["a", "c"]


def test_group_by_n(table, rows_of):
    df = table("a int, b int, c int", (1, 1, 5), (1, 1, 6), (1, 2, 7))
    assert rows_of(group_by_n(df, 2).agg(F.sum("c"))) == [(1, 1, 11), (1, 2, 7)]
    with pytest.raises(ValueError):
        group_by_n(df, 4)


# --- series


def test_generate_series(spark):
    assert [r[0] for r in generate_series(spark, 10).collect()] == list(range(1, 11))
    for wrong in (0, -1):
        with pytest.raises(ValueError):
            generate_series(spark, wrong)


def test_date_spine_excludes_the_end(spark):
    spine = date_spine(spark, "day", dt.date(2018, 1, 1), dt.date(2018, 1, 10))
    assert spine.columns == ["date_day"]
    assert sorted(r[0] for r in spine.collect()) == [dt.date(2018, 1, d) for d in range(1, 10)]


def test_date_spine_parts(spark):
    months = date_spine(spark, "month", "date'2024-01-31'", "date'2024-04-01'")
    assert sorted(r[0] for r in months.collect()) == [dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 31)]
    hours = date_spine(spark, "hour", "timestamp_ntz'2024-01-01 22:30:00'", "timestamp_ntz'2024-01-02 01:00:00'")
    assert sorted(r[0] for r in hours.collect()) == [dt.datetime(2024, 1, 1, 22, 30), dt.datetime(2024, 1, 1, 23, 30), dt.datetime(2024, 1, 2, 0, 30)]
    with pytest.raises(ValueError):
        date_spine(spark, "day", dt.date(2024, 1, 2), dt.date(2024, 1, 2))


def test_spine_longer_than_an_int(spark):
    spine = date_spine(spark, "second", "timestamp_ntz'1900-01-01 00:00:00'", "timestamp_ntz'1970-01-01 00:00:00'")
    assert " as int)" not in spine._jdf.queryExecution().optimizedPlan().toString()
    moment = add_part("second", F.lit(3_000_000_000), F.lit("1900-01-01").cast("timestamp_ntz"))
    assert spark.range(1).select(moment).first()[0] == dt.datetime(1995, 1, 25, 5, 20)


# --- introspection


@pytest.fixture
def letters(table):
    return table("field string, side string", *[(c, "left" if c in "aceg" else "right") for c in "abcdefggggg"])


def test_column_values(letters):
    assert [r.value for r in introspect.column_values(letters, "field").collect()] == ["g", *"abcdef"]
    assert introspect.column_value_list(letters, "field", order_by="field") == list("abcdefg")
    assert introspect.column_value_list(letters, "field", where="side = 'left'", order_by="field") == list("aceg")
    assert introspect.column_value_list(letters, "field", max_records=2) == ["g", "a"]
    assert introspect.column_value_list(letters, "field", order_by="min(side)", descending=True)[:3] == list("bdf")


def test_column_values_default(letters, spark):
    missing = introspect.table_or_none(spark, "no_such_table")
    assert introspect.column_value_list(missing, "field", default=["y", "z"]) == ["y", "z"]
    assert introspect.column_value_list(letters.limit(0), "field", default=["y"]) == ["y"]
    with pytest.raises(ValueError):
        introspect.column_value_list(missing, "field")


def test_null_is_a_column_value(table):
    assert introspect.column_value_list(table("x int", None, None, 1), "x") == [None, 1]


def test_single_value(table):
    df = table("d date, f double, i int, s string", (dt.date(2017, 1, 1), 3.3, 19, "string_a"))
    for column, value in zip(df.columns, df.first()):
        assert introspect.single_value(df.select(column)) == value
        assert df.select(introspect.single_value_column(df.select(column))).first()[0] == value
    assert introspect.single_value(df.filter("i < 0").select("i"), default=7) == 7
    assert df.select(introspect.single_value_column(df.filter("i < 0").select("i"), F.lit(7))).first()[0] == 7


def test_single_null_is_not_the_default(table):
    df = table("x int", None)
    assert introspect.single_value(df, default=7) is None
    assert df.select(introspect.single_value_column(df, F.lit(7))).first()[0] is None


def test_results_as_arrays(table):
    df = table("a int, b string, c boolean", (3, "c", None), (1, "a", True), (2, "b", False))
    expected = {"a": [1, 2, 3], "b": ["a", "b", "c"], "c": [True, False, None]}
    assert introspect.results_as_dict(df.orderBy("a")) == expected
    assert introspect.results_as_arrays(df, "a").first().asDict() == expected
    for too_small in (introspect.results_as_dict, lambda d, max_rows: introspect.results_as_arrays(d, "a", max_rows)):
        with pytest.raises(ValueError):
            too_small(df, max_rows=2)


# --- catalog


def test_relations_by_pattern_and_union(spark, table, rows_of):
    shards = [
        ("shards_one.events_20180101", [(1, "play"), (2, "pause")]),
        ("shards_one.events_20180102", [(3, "play"), (4, "pause")]),
        ("shards_two.events_20180103", [(5, "play"), (6, "pause")]),
        ("shards_one.other", [(7, "play")]),
    ]
    for name, rows in shards:
        saved = save_as_table(table("user_id int, event string", *rows), *name.split("."), ["user_id"])
        assert saved.count() == len(rows)
    everywhere = relations_by_pattern(spark, "shards%", "EVENTS_2018%")
    assert everywhere == [f"`{n.replace('.', '`.`')}`" for n, _ in shards[:3]]
    assert union_relations(open_relations(spark, everywhere)).count() == 6
    assert relations_by_pattern(spark, "shards%", "events_%", exclude="%0102") == [everywhere[0], everywhere[2]]
    prefixed = relations_by_prefix(spark, "shards_one", "events_")
    assert prefixed == everywhere[:2]
    union = union_relations(open_relations(spark, prefixed), source_column_name=None)
    assert rows_of(union) == [(1, "play"), (2, "pause"), (3, "play"), (4, "pause")]
    assert relations_by_prefix(spark, "shards_one", "missing") == []
    spark.sql("CREATE OR REPLACE VIEW shards_two.events_20180104 AS SELECT 1 AS user_id")
    assert tables_by_prefix(spark, "shards_two", "events") == [
        Relation("shards_two", "events_20180103", "table"),
        Relation("shards_two", "events_20180104", "view"),
    ]
    spark.sql("DROP VIEW shards_two.events_20180104")
    saved.createOrReplaceTempView("events_20180105")
    assert relations_by_pattern(spark, spark.catalog.currentDatabase(), "events_20180105") == ["`events_20180105`"]


def test_wildcards_in_names_are_literal_elsewhere(spark, table):
    spark.sql("CREATE DATABASE IF NOT EXISTS literal")
    table("x int", 1).write.mode("overwrite").saveAsTable("literal.ab")
    assert relations_by_pattern(spark, "literal", "a_") == ["`literal`.`ab`"]
    assert relations_by_pattern(spark, "literal", "a.") == []


# --- counted rows


def test_expand_counts(table, rows_of):
    df = table("x string, y int, n_rows bigint", ("a", None, 7), ("b", 1, 1), ("c", 2, 3))
    assert rows_of(expand_counts(df, chunk=3)) == [("a", None)] * 7 + [("b", 1)] + [("c", 2)] * 3
