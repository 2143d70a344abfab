"""Behaviour that matters on large and skewed tables."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from stratalake.checks import compare, groups, ordered
from stratalake.operators.dedupe import deduplicate
from stratalake.operators import ordered as ordered_operators
from stratalake.operators.ordered import by_rows, hot_groups, with_neighbour
from stratalake.operators.ranges import value_ranges
from stratalake.registry.operator_queries import union_event_shards
from stratalake.plans import gold, marts
from stratalake.session import DEFAULT_SHUFFLE_PARTITIONS, shuffle_partitions_for
from stratalake.sources import layers
from stratalake.sources.layers import clustered


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def even_rows(seed, n=400):
    """Groups and values without frequent values, some of them missing or repeated."""
    rng = random.Random(seed)
    return [(rng.randrange(1, 4), rng.randrange(2 * n) if rng.random() < 0.98 else None) for _ in range(n)] + [(9, 1)]


def skewed_rows(seed, n=400):
    """Groups and values where one group, one value and one whole row hold a third of the rows each."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        pick = rng.random()
        if pick < 0.33:
            rows.append((1, 50))
        elif pick < 0.66:
            rows.append((1, rng.randrange(200)))
        else:
            rows.append((rng.randrange(2, 6), rng.choice([50, None, rng.randrange(200)])))
    return rows


# --- sequences and ranges cut into value ranges


def sequential_by_hand(rows, grouped):
    found = []
    keyed = {}
    for group, value in rows:
        if value is not None:
            keyed.setdefault(group if grouped else None, []).append(value)
    for group, values in keyed.items():
        values.sort()
        for before, value in zip(values, values[1:]):
            if value != before + 1:
                found.append((group, value, before) if grouped else (value, before))
    return found


@pytest.mark.parametrize("make_rows", [skewed_rows, even_rows])
@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("grouped", [True, False])
@pytest.mark.parametrize("rows_per_range", [7, 60, 10_000])
def test_sequential_values_in_ranges(table, rows_of, make_rows, seed, grouped, rows_per_range):
    rows = make_rows(seed)
    df = table("g int, v int", *rows)
    group_by = ["g"] if grouped else []
    found = ordered.sequential_values(df, "v", group_by=group_by, rows_per_range=rows_per_range, n_ranges=9)
    assert rows_of(found) == sequential_by_hand(rows, grouped)


def ranges_by_hand(rows, grouped, gaps, zero_length):
    low = -(10**9)
    length_ok = (lambda a, b: a <= b) if zero_length else (lambda a, b: a < b)
    gap_ok = {
        "allowed": lambda a, b: a <= b,
        "not_allowed": lambda a, b: a == b,
        "required": lambda a, b: a < b,
    }[gaps]
    keyed = {}
    for group, lower, upper in rows:
        keyed.setdefault(group if grouped else None, []).append((lower, upper))
    found = []
    for group, ranges in keyed.items():
        ranges.sort(key=lambda r: tuple(low if x is None else x for x in r))
        for i, (lower, upper) in enumerate(ranges):
            last = i + 1 == len(ranges)
            after = None if last else ranges[i + 1][0]
            own = lower is not None and upper is not None and length_ok(lower, upper)
            following = gap_ok(upper, after) if upper is not None and after is not None else last
            if not (own and following):
                found.append(((group,) if grouped else ()) + (lower, upper, after, last, own, following))
    return found


@pytest.mark.parametrize("make_rows", [skewed_rows, even_rows])
@pytest.mark.parametrize("gaps", list(ordered.GAP_RULES))
@pytest.mark.parametrize("zero_length", [True, False])
@pytest.mark.parametrize("grouped, rows_per_range", [(True, 9), (False, 25), (True, 10_000), (False, 10_000)])
def test_exclusive_ranges_in_ranges(table, rows_of, make_rows, gaps, zero_length, grouped, rows_per_range):
    rng = random.Random(f"{gaps}{zero_length}{grouped}{rows_per_range}")
    rows = []
    for group, lower in make_rows(rng.random(), 250):
        upper = None if lower is None or rng.random() < 0.05 else lower + rng.choice([0, 1, 1, 2, 5, -1])
        rows.append((group, lower, upper))
    df = table("g int, lo int, hi int", *rows)
    found = ordered.mutually_exclusive_ranges(
        df,
        "lo",
        "hi",
        partition_by="g" if grouped else None,
        gaps=gaps,
        zero_length_range_allowed=zero_length,
        rows_per_range=rows_per_range,
        n_ranges=7,
    )
    assert rows_of(found) == ranges_by_hand(rows, grouped, gaps, zero_length)


def test_no_window_runs_over_everything_at_once(spark):
    """With several ranges only the ends of the ranges, one row each, come together in one task."""
    df = spark.range(100_000).withColumn("g", F.col("id") % 3)
    sequence = ordered.sequential_values(df, "id", n_ranges=10)
    ranges = ordered.mutually_exclusive_ranges(df, "id", "id + 1", n_ranges=10)
    for found in (sequence, ranges):
        plan = plan_of(found)
        below_single = plan.split("Exchange SinglePartition")[1:]
        assert len(below_single) == 1
        assert re.search(r"Aggregate\(keys?=\[_range", below_single[0].splitlines()[1]), below_single[0]
        assert found.count() == 0
    in_hot_groups = plan_of(ordered.sequential_values(df, "id", 3, group_by=["g"], rows_per_range=10_000))
    assert "SinglePartition" not in in_hot_groups and "_range" in in_hot_groups


def test_only_hot_groups_are_cut(spark, table, rows_of):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 2000).alias("g"), F.col("id").alias("v")
    )
    assert rows_of(hot_groups(df, ["g"], 1_000)) == [(None,)]
    gaps = ordered.sequential_values(df, "v", 3, group_by=["g"], rows_per_range=1_000)
    assert gaps.filter("g IS NULL").count() == 0
    in_small_groups = df.filter("g IS NOT NULL").count() - df.select("g").distinct().count() + 1
    assert gaps.count() == in_small_groups
    assert ordered.sequential_values(df.filter("v <> 9000"), "v", 3, group_by=["g"], rows_per_range=1_000).filter(
        "g IS NULL"
    ).collect() == [(None, 9003, 8997)]


@pytest.mark.parametrize("name", ["n", "p", "n_rows", "q"])
@pytest.mark.parametrize("make_rows", [skewed_rows, even_rows])
def test_group_columns_may_have_any_name(table, rows_of, make_rows, name):
    rows = make_rows(5)
    df = table(f"{name} int, v int", *rows)
    found = ordered.sequential_values(df, "v", group_by=[name], rows_per_range=30)
    assert found.columns == [name, "v", "previous_v"]
    assert rows_of(found) == sequential_by_hand(rows, True)


def test_small_groups_take_one_shuffle(spark):
    df = spark.range(50_000).select((F.col("id") % 4999).alias("g"), F.col("id").alias("v"))
    for found in (
        ordered.sequential_values(df, "v", 4999, group_by=["g"], rows_per_range=5_000),
        ordered.mutually_exclusive_ranges(df, "v", "v + 4999", "g", gaps="not_allowed", rows_per_range=5_000),
    ):
        plan = plan_of(found)
        assert plan.count("Exchange hashpartitioning") == 1 and "_range" not in plan
        assert found.count() == 0


# --- one shuffle of pre-aggregated rows


@pytest.mark.parametrize(
    "check",
    [
        lambda a, b: compare.equality(a, b),
        lambda a, b: compare.cardinality_equality(a, "k", b, "k"),
        lambda a, b: compare.equal_rowcount(a, b, ["k"]),
        lambda a, b: compare.fewer_rows_than(a, b, ["k"]),
        lambda a, b: compare.orphan_counts(a, "k", b, "k"),
        lambda a, b: groups.not_constant(a, "v", ["k"]),
        lambda a, b: groups.at_least_one(a, "v", ["k"]),
        lambda a, b: groups.unique(a, "k"),
        lambda a, b: groups.unique_combination_of_columns(a, ["k", "v"]),
    ],
)
def test_checks_shuffle_once_after_a_partial_aggregate(spark, check):
    a = spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") % 500).alias("v"))
    plan = plan_of(check(a, a.filter("v > 3")))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "Join" not in plan
    assert re.search(r"Exchange hashpartitioning.*\n.*HashAggregate.*partial|HashAggregate\(keys=.*functions=\[\]", plan)


def test_hot_key_checks_are_exact(table, rows_of):
    rows = skewed_rows(11)
    df = table("g int, v int", *rows)
    parents = table("v int", *[v for v in range(200) if v != 50])
    orphans = sum(1 for _, v in rows if v == 50)
    assert orphans > 100
    assert rows_of(compare.relationships_where(df, "v", parents, "v")) == [(50,)] * orphans
    assert rows_of(compare.orphan_counts(df, "v", parents, "v")) == [(50, orphans)]


def test_deduplicate_sends_one_row_per_key_and_task(spark):
    df = spark.range(0, 30_000, 1, 6).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    kept = deduplicate(df, ["k"], [F.col("id").desc()])
    assert kept.count() == 20_001
    assert kept.filter("k = -1").collect()[0].id == 29_997
    assert plan_of(kept).count("WindowGroupLimit") == 2


# --- layout


@pytest.fixture
def without_merged_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def sizes_in_order(laid_out):
    """Rows per partition; partitions hold values in order."""
    parts = laid_out.groupBy(F.spark_partition_id().alias("part")).agg(
        F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")
    )
    rows = parts.orderBy("part").collect()
    assert all(a.hi <= b.lo for a, b in zip(rows, rows[1:]) if a.hi is not None)
    return [r.n for r in rows]


KEYS = {
    "numbers": "xxhash64(id) % 1000000",
    "negative": "-id * 3",
    "hot": "if(id % 3 = 0, 30000, id)",
    "nulls": "if(id % 3 = 0, NULL, id)",
    "urls": "if(id = 7, 'ftp://a', concat('https://example.com/', lpad(cast(id * 7 AS string), 8, '0')))",
    "late texts": "concat('customer/2024/', xxhash64(id) % 1000000 + 5000000)",
    "binary": "unhex(sha2(cast(id AS string), 256))",
    "binary with one beginning": "cast(concat('prefix/prefix/', id) AS binary)",
    "no value": "cast(NULL AS string)",
    "large decimals": "cast(id / 7 AS decimal(30,4))",
    "decimals": "cast(id / 7 AS decimal(12,4))",
    "times": "timestamp_micros(id * 12345678)",
    "local times": "cast(timestamp_micros(id * 12345678) AS timestamp_ntz)",
    "dates": "date_from_unix_date(cast(id % 5000 AS int))",
    "doubles": "CASE id % 50 WHEN 0 THEN double('NaN') WHEN 1 THEN double('Infinity') ELSE id / -3.0D END",
}


@pytest.mark.parametrize("n_files", [2, 10])
@pytest.mark.parametrize("kind", KEYS)
def test_cluster_keys_of_any_type_are_balanced(spark, without_merged_partitions, kind, n_files):
    df = spark.range(0, 60_000, 1, 8).selectExpr(f"{KEYS[kind]} AS k", "id")
    sizes = sizes_in_order(clustered(df, ["k", "id"], n_files=n_files))
    assert len(sizes) >= n_files and sum(sizes) == 60_000 and max(sizes) <= 2 * 60_000 / n_files


@pytest.mark.parametrize("copies", [False, True])
def test_hot_cluster_key_is_spread(spark, without_merged_partitions, copies):
    """A key with a third of the rows, all different or all the same, spans several partitions."""
    value = "if(id % 3 = 0, 0, id)" if copies else "id"
    df = spark.range(0, 60_000, 1, 8).selectExpr(f"{KEYS['hot']} AS k", f"{value} AS v")
    laid_out = clustered(df, ["k"], n_files=12)
    assert laid_out.columns == ["k", "v"]
    sizes = sizes_in_order(laid_out)
    assert sum(sizes) == 60_000 and max(sizes) <= 10_000
    assert exactly_equal(laid_out, df)


@pytest.mark.parametrize("as_text", [False, True])
@pytest.mark.parametrize("apart", [False, True])
def test_cluster_keys_go_straight_to_their_range(spark, as_text, apart):
    """Ranges come from the key column alone; the plan itself has one shuffle, by the number of the range."""
    key = KEYS["late texts"] if as_text else KEYS["numbers"]
    df = spark.range(0, 60_000, 1, 8).selectExpr(f"{key} AS k", "id")
    laid_out = clustered(df, ["k", "id"], sample_from=df.select("k") if apart else None, n_files=8)
    plan = plan_of(laid_out)
    assert "rangepartitioning" not in plan and "direct_shuffle_partition_id" in plan
    assert plan.count("Exchange ") - plan.count("BroadcastExchange ") - plan.count("ReusedExchange ") == 1
    assert exactly_equal(laid_out, df)


def test_columns_with_the_names_of_helpers_are_kept(spark):
    df = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("_Value"), F.lit("x").alias("lo"))
    assert clustered(df, ["k"], n_files=3).count() == 100


def test_ranges_need_no_list_longer_than_a_level(spark):
    ranges = value_ranges(spark.range(0, 200_000, 1, 4).withColumnRenamed("id", "k"), "k", 10_000)
    assert ranges.coarse == ranges.fine == 100 and len(ranges.first_ends) == 99
    assert ranges.ends.agg(F.max(F.size("_ends"))).first()[0] == 99
    counts = ranges.assign(spark.range(200_000).withColumnRenamed("id", "k"), "r").groupBy("r").count()
    assert counts.agg(F.max("count")).first()[0] <= 40 and counts.count() >= 9_990
    assert value_ranges(spark.range(5).withColumnRenamed("id", "k"), "k", 10**12).n == 65_536


def test_ranges_are_placed_by_compiled_steps(spark):
    """Up to 256 ranges take one reading of the column, no join, and no loop over an array for each row."""
    df = spark.range(0, 60_000, 1, 8).selectExpr("id % 1000 AS k", "id")
    plan = plan_of(clustered(df, ["k"], n_files=200))
    assert "lambda" not in plan and "BroadcastExchange" not in plan
    assert value_ranges(df, "k", 256).ends is None and value_ranges(df, "k", 257).ends is not None
    assert [value_ranges(df, "k", n).n for n in (1, 3, 8, 256)] == [1, 4, 9, 256]


@pytest.mark.parametrize("n", [12, 1000])
@pytest.mark.parametrize("key", ["if(id % 3 = 0, 30000, id)", "if(id % 3 = 0, NULL, id)", "concat('k', if(id % 3 = 0, 3, 1 + id % 9))"])
def test_rows_of_a_value_are_in_the_ranges_that_it_parts(spark, n, key):
    df = spark.range(0, 60_000, 1, 8).selectExpr(f"{key} AS k", "id")
    ranges = value_ranges(df, "k", n)
    placed = ranges.assign(df, "r")
    assert exactly_equal(placed.drop("r"), df)
    parts = placed.groupBy("r").agg(F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("r").collect()
    assert all(a.hi <= b.lo for a, b in zip(parts, parts[1:]) if a.hi is not None and b.lo is not None)
    assert max(p.n for p in parts) <= 4 * 60_000 / ranges.n


def test_columns_with_the_names_of_helpers_keep_their_values(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("_Value"), F.lit(2).alias("__Salt"), F.lit(3).alias("_place"))
    for n in (3, 300):
        assert exactly_equal(value_ranges(df, "k", n).assign(df, "r").drop("r"), df)


def test_ranges_of_an_empty_table(spark, table):
    for ddl in ("k string", "k double", "k int"):
        assert clustered(table(ddl), ["k"], n_files=4).count() == 0


def test_small_tables_are_sorted(spark):
    df = spark.range(100).select((100 - F.col("id")).alias("k"))
    assert [r.k for r in clustered(df, ["k"]).collect()] == list(range(1, 101))


def test_partitions_for_a_table():
    assert layers._partitions_for(0, 8) == 8
    assert layers._partitions_for(5_000_000, 8) == 8
    assert layers._partitions_for(50_000_000, 8) == 50
    assert layers._partitions_for(10**13, 8) == 10**7


def exactly_equal(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_marts_sum_up_before_the_product_join(table):
    orders = table(
        "ProductID bigint, OrderDate date, TotalLineExtendedPrice double, LeadTimeInBusinessDays bigint",
        (1, dt.date(2024, 1, 1), 5.0, 2),
    )
    products = table("ProductId bigint, Color string, ProductCategoryName string", (1, "red", "Bikes"))
    for mart in (marts.avg_lead_time_prod_category, marts.color_with_highest_reven_year):
        plan = plan_of(mart(orders, products))
        join_at = plan.index("Join")
        assert "HashAggregate" in plan[join_at:], "the line side is aggregated below the join"


def test_shuffle_partitions_follow_the_data():
    assert shuffle_partitions_for(0) == DEFAULT_SHUFFLE_PARTITIONS
    assert 10_000 < shuffle_partitions_for(100 * 10**12) < 100_000


def test_ranges_keep_their_size_at_any_number_of_rows():
    assert by_rows(200_000)(10**12) * 200_000 >= 10**12


def largest_range(monkeypatch, df, check):
    """Rows of the largest range that the check writes."""
    sizes, write = [], ordered_operators._written

    def watched(df, purpose):
        table = write(df, purpose)
        if purpose == "ranges":
            sizes.append(table.groupBy("_range").count().agg(F.max("count")).first()[0])
        return table

    monkeypatch.setattr(ordered_operators, "_written", watched)
    check(df)
    return max(sizes)


def test_ranges_of_texts_and_bytes_are_balanced(spark, monkeypatch):
    urls = spark.range(20_000).select(F.format_string("https://example.com/%08d", "id").alias("v"))
    urls = urls.union(spark.sql("SELECT 'ftp://a'"))
    for df in (urls, urls.select(F.col("v").cast("binary").alias("v"))):
        check = lambda df: ordered.mutually_exclusive_ranges(df, "v", "v", n_ranges=10)
        assert largest_range(monkeypatch, df, check) <= 4_000


@pytest.mark.parametrize("side", ["previous", "next"])
def test_ties_keep_all_rows(table, side):
    rows = [(v, 1000 * v + n) for v in range(40) for n in reversed(range(100))]
    df = table("v int, payload int", *rows).repartition(5)
    linked = with_neighbour(df, "v", "beside", side, in_ranges=True, n_ranges=8)
    assert sorted(r.payload for r in linked.collect()) == sorted(p for _, p in rows)
    assert linked.filter("_end").count() == 1


def test_equal_revenues_tie(table):
    orders = table(
        "ProductID bigint, OrderDate date, TotalLineExtendedPrice double, LeadTimeInBusinessDays bigint",
        *[(i, dt.date(2024, 1, 1), price, 2) for i, price in ((1, 0.1), (1, 0.2), (2, 0.3))],
    )
    products = table("ProductId bigint, Color string", (1, "red"), (2, "blue"))
    assert {r.Color for r in marts.color_with_highest_reven_year(orders, products).collect()} == {"red", "blue"}


def test_event_shards_keep_events_without_a_time(spark, table):
    times = [dt.datetime(2024, 1, day) for day in (1, 11, 21)]
    events = table("event_id int, ts timestamp_ntz", *enumerate([*times, None]))
    found = {r.event_id: r.shard for r in union_event_shards(spark, events).collect()}
    assert found == {0: "`event_shard_20240101`", 1: "`event_shard_20240111`", 2: "`event_shard_20240121`", 3: "`event_shard_20240121`"}
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("event_shard")]


def test_hot_order_is_split_in_the_gold_join(spark):
    """With thresholds that fit the test's size, the adaptive skew join splits the hot order."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        order_id = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
        now = F.current_timestamp()
        lines = spark.range(0, 200_000, 1, 8).select(
            F.col("id").alias("SalesOrderDetailID"),
            order_id.alias("SalesOrderID"),
            F.lit(1).cast("bigint").alias("OrderQty"),
            (F.col("id") % 100).alias("ProductID"),
            F.rand(1).alias("UnitPrice"),
            F.lit(0.0).alias("UnitPriceDiscount"),
            now.alias("_sequence"),
            now.alias("_internal_sequence"),
        )
        day = F.lit("2024-01-05").cast("date")
        header = spark.range(0, 5000, 1, 4).select(
            F.col("id").alias("SalesOrderID"),
            day.alias("OrderDate"),
            day.alias("ShipDate"),
            F.lit(True).alias("OnlineOrderFlag"),
            F.lit("A").alias("AccountNumber"),
            F.lit(1).cast("bigint").alias("CustomerID"),
            F.lit(1).cast("bigint").alias("SalesPersonID"),
            F.lit(1.0).alias("Freight"),
        )
        orders = gold.publish_orders(header, lines)
        assert len(orders.collect()) == 200_000
        assert "SortMergeJoin(skew=true)" in plan_of(orders)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
