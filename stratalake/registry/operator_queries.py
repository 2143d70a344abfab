"""Table operators and column functions on the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.dates import business_days as business_days_of
from stratalake.functions.numbers import haversine_distance, safe_add, safe_divide, safe_subtract, width_bucket
from stratalake.functions.text import slugify, surrogate_key
from stratalake.functions.urls import url_host, url_parameter, url_path
from stratalake.operators import introspect
from stratalake.operators.dedupe import deduplicate
from stratalake.operators.project import filtered_columns, group_by_n, nullcheck_table, star
from stratalake.operators.reshape import pivot, unpivot
from stratalake.operators.series import date_spine, generate_series
from stratalake.operators.union import union_relations
from stratalake.registry.book import QueryBook
from stratalake.registry.sales_sql import with_tables
from stratalake.sources.catalog import open_relations, relations_by_pattern
from stratalake.sources.files import load_table
from stratalake.sources.layers import publish_view
from stratalake.sources.sales import sales_sources

BOOK = QueryBook()


@BOOK.add(
    "business_days",
    """
    SELECT l_returnflag, l_linestatus, CAST(sum(days * lines) AS BIGINT) AS total_days,
           CAST(sum(lines) AS BIGINT) AS measured_lines
    FROM (
        SELECT *, len(list_filter(generate_series(o_orderdate, l_shipdate, INTERVAL 1 DAY),
                                  lambda d: isodow(d) NOT IN (6, 7))) AS days
        FROM (SELECT l_returnflag, l_linestatus, o_orderdate, l_shipdate, count(*) AS lines
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey
              WHERE l_shipdate >= o_orderdate GROUP BY ALL)
    ) GROUP BY ALL
    """,
)
def business_days(spark: SparkSession, directory: str) -> DataFrame:
    """Lead time of every line, summed per return flag and line status.

    Lines that give the same answer are counted before the join.
    """
    orders = load_table(spark, directory, "orders").select("o_orderkey", "o_orderdate")
    lines = (
        load_table(spark, directory, "lineitem")
        .groupBy("l_orderkey", F.col("l_shipdate").cast("date").alias("shipped"), "l_returnflag", "l_linestatus")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    days = business_days_of(F.col("o_orderdate").cast("date"), F.col("shipped"))
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("days", days)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum(F.col("days") * F.col("n")).alias("total_days"),
            F.sum(F.when(F.col("days").isNotNull(), F.col("n"))).alias("measured_lines"),
        )
    )


_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@BOOK.add(
    "deduplicate",
    """
    SELECT * FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                                        l_discount, l_tax) = 1
    """,
)
def deduplicate_lines(spark: SparkSession, directory: str) -> DataFrame:
    order = [F.col("l_shipdate").desc(), *[F.col(c) for c in _LINE_ORDER[1:]]]
    return deduplicate(load_table(spark, directory, "lineitem"), ["l_orderkey", "l_linenumber"], order)


def _parties(spark: SparkSession, directory: str) -> list[tuple[str, DataFrame]]:
    customers = load_table(spark, directory, "customer").select(
        F.col("c_custkey").alias("party_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation_key"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    suppliers = load_table(spark, directory, "supplier").select(
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("Balance"),
        F.col("s_suppkey").cast("string").alias("party_id"),
        F.col("s_nationkey").alias("nation_key"),
        F.lit(True).alias("is_supplier"),
    )
    return [("customers", customers), ("suppliers", suppliers)]


@BOOK.add(
    "union_relations",
    """
    SELECT 'customers' AS _dbt_source_relation, c_custkey AS party_id, c_name AS name,
           CAST(c_nationkey AS BIGINT) AS nation_key, c_mktsegment AS segment, c_acctbal AS balance,
           CAST(NULL AS BOOLEAN) AS is_supplier
    FROM customer WHERE c_acctbal > 0
    UNION ALL
    SELECT 'suppliers', s_suppkey, s_name, s_nationkey, NULL, s_acctbal, TRUE
    FROM supplier WHERE s_acctbal > 0
    """,
)
def union_of_parties(spark: SparkSession, directory: str) -> DataFrame:
    return union_relations(
        _parties(spark, directory), column_override={"NATION_KEY": "bigint"}, where="balance > 0"
    )


@BOOK.add(
    "union_relations_exclude",
    """
    SELECT c_custkey AS party_id, c_name AS name, c_acctbal AS balance, CAST(NULL AS BOOLEAN) AS is_supplier
    FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, TRUE FROM supplier
    """,
)
def union_without_columns(spark: SparkSession, directory: str) -> DataFrame:
    return union_relations(
        _parties(spark, directory), exclude=["SEGMENT", "nation_key"], source_column_name=None
    )


@BOOK.add(
    "pivot",
    """
    SELECT o_orderstatus,
           CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS "1-URGENT",
           CAST(sum(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS BIGINT) AS "5-LOW",
           CAST(sum(CASE WHEN o_orderpriority = 'never used' THEN 1 ELSE 0 END) AS BIGINT) AS "never used"
    FROM orders GROUP BY 1
    """,
)
def pivot_priorities(spark: SparkSession, directory: str) -> DataFrame:
    orders = load_table(spark, directory, "orders")
    return pivot(orders, ["o_orderstatus"], "o_orderpriority", ["1-URGENT", "5-LOW", "never used"])


@BOOK.add(
    "pivot_options",
    """
    SELECT l_returnflag,
           count(DISTINCT CASE WHEN l_linestatus = 'O' THEN l_suppkey END) AS _1_o_suppliers,
           count(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_suppkey END) AS _1_f_suppliers
    FROM lineitem GROUP BY 1
    """,
)
def pivot_distinct_suppliers(spark: SparkSession, directory: str) -> DataFrame:
    return pivot(
        load_table(spark, directory, "lineitem"),
        ["l_returnflag"],
        "l_linestatus",
        ["O", "F"],
        agg="count",
        then_value="l_suppkey",
        else_value=None,
        distinct=True,
        prefix="1 ",
        suffix="-suppliers",
        quote_identifiers=False,
    )


@BOOK.add(
    "unpivot",
    """
    SELECT p_partkey, 'p_brand' AS field_name, p_brand AS value FROM part
    UNION ALL SELECT p_partkey, 'p_type', p_type FROM part
    UNION ALL SELECT p_partkey, 'p_size', CAST(nullif(p_size, 7) AS VARCHAR) FROM part
    UNION ALL SELECT p_partkey, 'is_large', CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END FROM part
    """,
)
def unpivot_parts(spark: SparkSession, directory: str) -> DataFrame:
    part = load_table(spark, directory, "part").withColumns(
        {"is_large": F.col("p_size") > 25, "p_size": F.nullif(F.col("p_size"), F.lit(7))}
    )
    return unpivot(part, exclude=["p_partkey"], remove=["P_NAME", "p_retailprice"])


@BOOK.add(
    "star",
    """
    SELECT s_suppkey AS x_s_suppkey_y, s_nationkey AS x_s_nationkey_y, s_acctbal AS x_s_acctbal_y
    FROM supplier
    """,
)
def star_prefixed(spark: SparkSession, directory: str) -> DataFrame:
    suppliers = load_table(spark, directory, "supplier").alias("s")
    return suppliers.select(*star(suppliers, ["S_NAME"], prefix="x_", suffix="_y", relation_alias="s"))


@BOOK.add(
    "star_aggregate",
    """
    SELECT l_returnflag, l_linestatus, CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem GROUP BY 1, 2
    """,
)
def star_grouped(spark: SparkSession, directory: str) -> DataFrame:
    lines = load_table(spark, directory, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    return lines.groupBy(*star(lines, ["l_linenumber"])).agg(F.sum("l_linenumber").alias("total"))


@BOOK.add(
    "filtered_columns",
    """
    SELECT max(o_orderkey) AS max_o_orderkey, max(o_custkey) AS max_o_custkey,
           max(o_orderstatus) AS max_o_orderstatus, max(o_totalprice) AS max_o_totalprice,
           max(o_orderdate) AS max_o_orderdate
    FROM orders
    """,
)
def max_of_columns(spark: SparkSession, directory: str) -> DataFrame:
    orders = load_table(spark, directory, "orders")
    return orders.agg(*[F.max(c).alias(f"max_{c}") for c in filtered_columns(orders, ["O_ORDERPRIORITY"])])


@BOOK.add(
    "nullcheck",
    with_tables(
        ["src_products"],
        """
        SELECT CAST(ProductID AS VARCHAR) AS ProductID, nullif(Color, '') AS Color,
               nullif(ProductCategoryName, '') AS ProductCategoryName, length(ProductDesc) AS name_length
        FROM src_products
        """,
    ),
)
def nullcheck_products(spark: SparkSession, directory: str) -> DataFrame:
    products = sales_sources(spark, directory)["src_products"]
    length = F.length("ProductDesc").cast("bigint").alias("name_length")
    return nullcheck_table(products.select("ProductID", "Color", "ProductCategoryName", length))


@BOOK.add(
    "surrogate_key",
    """
    SELECT l_orderkey, l_linenumber,
           md5(concat_ws('-', l_orderkey, l_linenumber,
                         coalesce(nullif(l_returnflag, 'A'), '_dbt_utils_surrogate_key_null_'),
                         strftime(l_shipdate, '%Y-%m-%d'))) AS line_key,
           md5(concat_ws('-', l_orderkey, coalesce(nullif(l_returnflag, 'A'), ''))) AS legacy_key
    FROM lineitem
    """,
)
def surrogate_keys(spark: SparkSession, directory: str) -> DataFrame:
    flag = F.nullif(F.col("l_returnflag"), F.lit("A"))
    day = F.col("l_shipdate").cast("date")
    return load_table(spark, directory, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        surrogate_key(["l_orderkey", "l_linenumber", flag, day]).alias("line_key"),
        surrogate_key(["l_orderkey", flag], nulls_as_empty=True).alias("legacy_key"),
    )


@BOOK.add(
    "generate_series",
    """
    SELECT g AS generated_number FROM generate_series(1, (SELECT max(o_orderkey) FROM orders)) t(g)
    WHERE g NOT IN (SELECT l_orderkey FROM lineitem)
    """,
)
def order_numbers_without_lines(spark: SparkSession, directory: str) -> DataFrame:
    """All order numbers up to the highest one that no line uses."""
    highest = introspect.single_value(load_table(spark, directory, "orders").agg(F.max("o_orderkey")))
    used = load_table(spark, directory, "lineitem").select("l_orderkey").distinct()
    numbers = generate_series(spark, highest)
    return numbers.join(used, F.col("generated_number") == F.col("l_orderkey"), "left_anti")


def _first_and_last(df: DataFrame, moment: Column) -> tuple[Column, Column]:
    """Earliest and latest moment as constants, from one row."""
    row = df.agg(F.min(moment).cast("string"), F.max(moment).cast("string")).first()
    return tuple(F.lit(text).cast("timestamp_ntz") for text in row)


@BOOK.add(
    "date_spine",
    """
    SELECT CAST(m AS DATE) AS date_month, coalesce(n, 0) AS orders, round(coalesce(revenue, 0), 2) AS revenue
    FROM generate_series((SELECT date_trunc('month', min(o_orderdate)) FROM orders),
                         (SELECT date_trunc('month', max(o_orderdate)) FROM orders),
                         INTERVAL 1 MONTH) t(m)
    LEFT JOIN (SELECT date_trunc('month', o_orderdate) AS month, count(*) AS n, sum(o_totalprice) AS revenue
               FROM orders WHERE o_totalprice > 495000 GROUP BY 1) ON month = m
    """,
)
def monthly_large_orders(spark: SparkSession, directory: str) -> DataFrame:
    orders = load_table(spark, directory, "orders")
    first, last = _first_and_last(orders, F.date_trunc("month", "o_orderdate"))
    spine = date_spine(spark, "month", first, last + F.expr("INTERVAL 1 MONTH"))
    sums = (
        orders.filter("o_totalprice > 495000")
        .groupBy(F.trunc("o_orderdate", "month").alias("month"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))
    )
    return spine.join(sums, F.col("date_month") == F.col("month"), "left").select(
        "date_month",
        F.coalesce("n", F.lit(0).cast("bigint")).alias("orders"),
        F.round(F.coalesce("total", F.lit(0.0)), 2).alias("revenue"),
    )


@BOOK.add(
    "hourly_gap_fill",
    """
    SELECT h AS date_hour, coalesce(n, 0) AS errors
    FROM generate_series((SELECT date_trunc('hour', min(ts)) FROM events),
                         (SELECT date_trunc('hour', max(ts)) FROM events), INTERVAL 1 HOUR) t(h)
    LEFT JOIN (SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events WHERE event_type = 'error'
               GROUP BY 1) ON hour = h
    """,
)
def hourly_errors(spark: SparkSession, directory: str) -> DataFrame:
    """Errors per hour, hours without any included."""
    events = load_table(spark, directory, "events")
    first, last = _first_and_last(events, F.date_trunc("hour", F.col("ts")))
    spine = date_spine(spark, "hour", first, last + F.expr("INTERVAL 1 HOUR"))
    errors = (
        events.filter("event_type = 'error'")
        .groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return spine.join(errors, F.col("date_hour") == F.col("hour"), "left").select(
        "date_hour", F.coalesce("n", F.lit(0).cast("bigint")).alias("errors")
    )


@BOOK.add(
    "group_by_n",
    """
    SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS lines, round(sum(l_quantity), 2) AS quantity
    FROM lineitem GROUP BY 1, 2, 3
    """,
)
def group_by_first_columns(spark: SparkSession, directory: str) -> DataFrame:
    columns = ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity"]
    lines = load_table(spark, directory, "lineitem").select(*columns)
    return group_by_n(lines, 3).agg(
        F.count(F.lit(1)).alias("lines"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


def _with_gaps(spark: SparkSession, directory: str) -> DataFrame:
    """Lines whose quantity, line number or discount is NULL for some values."""
    return load_table(spark, directory, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif(F.col("l_linenumber").cast("bigint"), F.lit(3)).alias("a"),
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity").cast("bigint")).alias("b"),
        F.when(F.col("l_linestatus") == "O", F.col("l_suppkey")).alias("c"),
    )


_GAPS = """
    SELECT l_orderkey, l_linenumber, nullif(CAST(l_linenumber AS BIGINT), 3) AS a,
           CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS BIGINT) END AS b,
           CASE WHEN l_linestatus = 'O' THEN l_suppkey END AS c
    FROM lineitem
"""


@BOOK.add(
    "safe_add",
    f"""
    SELECT l_orderkey, l_linenumber, coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0) AS total FROM ({_GAPS})
    """,
)
def safe_sums(spark: SparkSession, directory: str) -> DataFrame:
    lines = _with_gaps(spark, directory)
    return lines.select("l_orderkey", "l_linenumber", safe_add(["a", "b", "c"]).alias("total"))


@BOOK.add(
    "safe_subtract",
    f"""
    SELECT l_orderkey, l_linenumber, coalesce(a, 0) - coalesce(b, 0) - coalesce(c, 0) AS rest FROM ({_GAPS})
    """,
)
def safe_differences(spark: SparkSession, directory: str) -> DataFrame:
    lines = _with_gaps(spark, directory)
    return lines.select("l_orderkey", "l_linenumber", safe_subtract(["a", "b", "c"]).alias("rest"))


@BOOK.add(
    "safe_divide",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_discount, 0) AS by_discount,
           (l_quantity * 2) / nullif(l_linenumber - 3, 0) AS by_number
    FROM lineitem
    """,
)
def safe_quotients(spark: SparkSession, directory: str) -> DataFrame:
    return load_table(spark, directory, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        safe_divide("l_extendedprice", "l_discount").alias("by_discount"),
        safe_divide("l_quantity * 2", "l_linenumber - 3").alias("by_number"),
    )


@BOOK.add(
    "width_bucket",
    """
    SELECT CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice >= 450000 THEN 21
                ELSE CAST(floor(20 * (o_totalprice - 50000) / 400000) AS BIGINT) + 1 END AS bucket,
           count(*) AS orders, min(o_totalprice) AS lowest, max(o_totalprice) AS highest
    FROM orders GROUP BY 1
    """,
)
def price_histogram(spark: SparkSession, directory: str) -> DataFrame:
    price = F.col("o_totalprice")
    return (
        load_table(spark, directory, "orders")
        .groupBy(width_bucket(price, 50_000, 450_000, 20).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("orders"), F.min(price).alias("lowest"), F.max(price).alias("highest"))
    )


def _place(key: Column, step_lat: int, step_lon: int) -> tuple[Column, Column]:
    """A made-up but fixed position for a key, in degrees."""
    return (key * step_lat % 18000) / 100 - 90, (key * step_lon % 36000) / 100 - 180


@BOOK.add(
    "haversine_distance",
    """
    WITH places AS (
        SELECT radians((o_custkey * 7919 % 18000) / 100 - 90) AS phi1,
               radians((o_custkey * 104729 % 36000) / 100 - 180) AS lam1,
               radians((l_suppkey * 6007 % 18000) / 100 - 90) AS phi2,
               radians((l_suppkey * 15485863 % 36000) / 100 - 180) AS lam2, s_nationkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
    )
    SELECT n_name, count(*) AS lines,
           round(avg(2 * 3961 * asin(sqrt(least(1.0::DOUBLE,
               pow(sin((phi2 - phi1) / 2), 2) + cos(phi1) * cos(phi2) * pow(sin((lam2 - lam1) / 2), 2))))
               * 1.60934), 3) AS avg_km
    FROM places JOIN nation ON s_nationkey = n_nationkey GROUP BY 1
    """,
)
def shipping_distance(spark: SparkSession, directory: str) -> DataFrame:
    """Average distance from supplier to customer over all lines, per supplier nation.

    Lines are counted per order and supplier before the join, so an order that
    holds much of the table is not a hot join key.
    """
    per_order = (
        load_table(spark, directory, "lineitem")
        .groupBy("l_orderkey", "l_suppkey")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    orders = load_table(spark, directory, "orders").select("o_orderkey", "o_custkey")
    customer = _place(F.col("o_custkey"), 7919, 104729)
    supplier = _place(F.col("l_suppkey"), 6007, 15485863)
    distance = haversine_distance(*customer, *supplier, unit="km")
    per_supplier = (
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_suppkey")
        .agg(F.sum(distance * F.col("n")).alias("km"), F.sum("n").alias("n"))
    )
    suppliers = load_table(spark, directory, "supplier").select("s_suppkey", "s_nationkey")
    nations = load_table(spark, directory, "nation").select("n_nationkey", "n_name")
    return (
        per_supplier.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey")
        .agg(F.sum("km").alias("km"), F.sum("n").alias("n"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("n_name", F.col("n").alias("lines"), F.round(F.col("km") / F.col("n"), 3).alias("avg_km"))
    )


@BOOK.add(
    "column_values",
    """
    SELECT l_partkey AS value FROM lineitem WHERE l_returnflag <> 'N'
    GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 25
    """,
)
def most_sold_parts(spark: SparkSession, directory: str) -> DataFrame:
    lines = load_table(spark, directory, "lineitem")
    return introspect.column_values(lines, "l_partkey", max_records=25, where="l_returnflag <> 'N'")


@BOOK.add(
    "dynamic_pivot",
    """
    SELECT p_brand,
           CAST(sum(CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 0 END) AS BIGINT) AS n_economy,
           CAST(sum(CASE WHEN p_type = 'LARGE' THEN 1 ELSE 0 END) AS BIGINT) AS n_large,
           CAST(sum(CASE WHEN p_type = 'MEDIUM' THEN 1 ELSE 0 END) AS BIGINT) AS n_medium,
           CAST(sum(CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END) AS BIGINT) AS n_promo,
           CAST(sum(CASE WHEN p_type = 'SMALL' THEN 1 ELSE 0 END) AS BIGINT) AS n_small,
           CAST(sum(CASE WHEN p_type = 'STANDARD' THEN 1 ELSE 0 END) AS BIGINT) AS n_standard
    FROM part GROUP BY 1
    """,
)
def pivot_on_found_values(spark: SparkSession, directory: str) -> DataFrame:
    part = load_table(spark, directory, "part")
    types = introspect.column_value_list(part, "p_type")
    return pivot(part, ["p_brand"], "p_type", types, prefix="n_", quote_identifiers=False)


@BOOK.add(
    "single_value",
    """
    SELECT o_orderkey,
           date_diff('day', o_orderdate, (SELECT max(l_shipdate) FROM lineitem)) AS days_to_last_shipment,
           -1 AS no_rows_default
    FROM orders
    """,
)
def days_to_last_shipment(spark: SparkSession, directory: str) -> DataFrame:
    lines = load_table(spark, directory, "lineitem")
    last = introspect.single_value_column(lines.agg(F.max("l_shipdate")))
    none = introspect.single_value_column(lines.filter("l_quantity < 0").select("l_linenumber"), F.lit(-1))
    return load_table(spark, directory, "orders").select(
        "o_orderkey",
        F.datediff(last, F.col("o_orderdate")).cast("bigint").alias("days_to_last_shipment"),
        none.alias("no_rows_default"),
    )


@BOOK.add(
    "results_as_arrays",
    """
    SELECT string_agg(o_orderpriority, '; ' ORDER BY o_orderpriority) AS o_orderpriority,
           string_agg(CAST(n AS VARCHAR), '; ' ORDER BY o_orderpriority) AS n,
           string_agg(coalesce(CAST(urgent AS VARCHAR), 'NULL'), '; ' ORDER BY o_orderpriority) AS urgent
    FROM (SELECT o_orderpriority, count(*) AS n,
                 CASE WHEN o_orderpriority = '1-URGENT' THEN count(DISTINCT o_custkey) END AS urgent
          FROM orders GROUP BY 1)
    """,
)
def priorities_as_arrays(spark: SparkSession, directory: str) -> DataFrame:
    customers = F.count_distinct("o_custkey")
    counts = (
        load_table(spark, directory, "orders")
        .groupBy("o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n"), customers.alias("customers"))
        .withColumn("urgent", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("customers")))
        .drop("customers")
    )
    arrays = introspect.results_as_arrays(counts, order_by="o_orderpriority")
    return arrays.select(*[F.array_join(c, "; ", "NULL").alias(c) for c in arrays.columns])


@BOOK.add(
    "results_in_columns",
    """
    WITH customers AS (
        SELECT o_custkey, count(*) AS n, max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END) AS last_urgent
        FROM orders GROUP BY 1
    ), placed AS (SELECT *, row_number() OVER (ORDER BY n, o_custkey) - 1 AS position FROM customers)
    SELECT 'o_custkey' AS column_name, position, CAST(o_custkey AS VARCHAR) AS value FROM placed
    UNION ALL SELECT 'n', position, CAST(n AS VARCHAR) FROM placed
    UNION ALL SELECT 'last_urgent', position, CAST(last_urgent AS VARCHAR) FROM placed
    """,
)
def customers_in_columns(spark: SparkSession, directory: str) -> DataFrame:
    """Customers in the order of their number of orders, column by column."""
    urgent = F.max(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderkey")))
    customers = load_table(spark, directory, "orders").groupBy("o_custkey")
    counts = customers.agg(F.count(F.lit(1)).alias("n"), urgent.alias("last_urgent"))
    return introspect.results_in_columns(counts, ["n", "o_custkey"])


@BOOK.add(
    "union_sharded_events",
    """
    SELECT event_id, user_id, event_type, value, ts,
           CASE WHEN ts < '2024-01-11' THEN '`event_shard_20240101`'
                WHEN ts < '2024-01-21' THEN '`event_shard_20240111`'
                ELSE '`event_shard_20240121`' END AS shard
    FROM events
    """,
)
def union_sharded_events(spark: SparkSession, directory: str) -> DataFrame:
    """Events cut into three dated views, found again by prefix and put together."""
    events = load_table(spark, directory, "events").select("event_id", "user_id", "event_type", "value", "ts")
    return union_event_shards(spark, events)


def union_event_shards(spark: SparkSession, events: DataFrame) -> DataFrame:
    """The views live only while they are looked up; events without a time are in the last one."""
    own = f"{uuid.uuid4().hex}_"
    ts = F.col("ts")
    shards = {
        "20240101": events.filter(ts < "2024-01-11"),
        "20240111": events.filter((ts >= "2024-01-11") & (ts < "2024-01-21")),
        "20240121": events.filter(ts.isNull() | (ts >= "2024-01-21")),
    }
    for day, shard in shards.items():
        publish_view(shard, f"event_shard_{own}{day}")
    names = relations_by_pattern(spark, spark.catalog.currentDatabase(), f"EVENT_SHARD_{own}2024%")
    together = union_relations(open_relations(spark, names), source_column_name="shard")
    for day in shards:
        spark.catalog.dropTempView(f"event_shard_{own}{day}")
    return together.withColumn("shard", F.replace("shard", F.lit(own), F.lit("")))


_BARE_URL = "replace(replace(url, 'http://', ''), 'https://', '')"


@BOOK.add(
    "url_hosts",
    f"SELECT split_part(split_part({_BARE_URL}, '/', 1), '?', 1) AS host, count(*) AS pages FROM pages GROUP BY 1",
)
def pages_per_host(spark: SparkSession, directory: str) -> DataFrame:
    pages = load_table(spark, directory, "pages")
    return pages.groupBy(url_host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("pages"))


@BOOK.add(
    "url_paths",
    f"""
    SELECT CASE WHEN bare LIKE '%/%' THEN bare[instr(bare, '/') + 1:] ELSE '' END AS path, count(*) AS pages
    FROM (SELECT split_part({_BARE_URL}, '?', 1) AS bare FROM pages) GROUP BY 1
    """,
)
def pages_per_path(spark: SparkSession, directory: str) -> DataFrame:
    pages = load_table(spark, directory, "pages")
    return pages.groupBy(url_path(F.col("url")).alias("path")).agg(F.count(F.lit(1)).alias("pages"))


@BOOK.add(
    "url_params",
    """
    SELECT nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm_source,
           nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref, count(*) AS pages
    FROM pages GROUP BY 1, 2
    """,
)
def pages_per_parameter(spark: SparkSession, directory: str) -> DataFrame:
    url = F.col("url")
    return (
        load_table(spark, directory, "pages")
        .groupBy(url_parameter(url, "utm_source").alias("utm_source"), url_parameter(url, "ref").alias("ref"))
        .agg(F.count(F.lit(1)).alias("pages"))
    )


@BOOK.add(
    "slugify",
    """
    SELECT o_orderkey,
           regexp_replace(regexp_replace(regexp_replace(lower(o_orderpriority || ' / ' || o_orderstatus),
               '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g'), '^([0-9])', '_\\1') AS slug
    FROM orders
    """,
)
def order_slugs(spark: SparkSession, directory: str) -> DataFrame:
    label = F.concat_ws(" / ", "o_orderpriority", "o_orderstatus")
    return load_table(spark, directory, "orders").select("o_orderkey", slugify(label).alias("slug"))
