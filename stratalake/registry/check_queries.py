"""Data checks on the test tables.

The tables are clean in most respects, so many queries look at a column that is
NULLed or shifted for some values: a check that finds nothing proves little.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.checks import bitmaps, compare, groups, ordered, rows, runner, schema
from stratalake.operators import introspect
from stratalake.operators.reshape import pivot
from stratalake.plans.layered_run import LINE_TOTAL, build_layers
from stratalake.registry.book import QueryBook
from stratalake.registry.sales_sql import with_tables
from stratalake.sources.files import load_table
from stratalake.sources.sales import sales_sources

BOOK = QueryBook()


def _sales(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return build_layers(sales_sources(spark, directory))[name]


@BOOK.add(
    "chk_accepted_range",
    "SELECT * FROM orders WHERE NOT (o_totalprice > 2000) OR NOT (o_totalprice < 490000 + o_custkey)",
)
def chk_accepted_range(spark: SparkSession, directory: str) -> DataFrame:
    orders = load_table(spark, directory, "orders")
    return rows.accepted_range(orders, "o_totalprice", 2000, "490000 + o_custkey", inclusive=False)


@BOOK.add(
    "chk_at_least_one",
    """
    SELECT user_id, count(large) AS filler_column
    FROM (SELECT *, CASE WHEN event_type = 'purchase' AND value > 100 THEN event_id END AS large FROM events)
    GROUP BY 1 HAVING count(large) = 0
    """,
)
def chk_at_least_one(spark: SparkSession, directory: str) -> DataFrame:
    """Users without a large purchase."""
    large = F.when((F.col("event_type") == "purchase") & (F.col("value") > 100), F.col("event_id"))
    return groups.at_least_one(load_table(spark, directory, "events").withColumn("large", large), "large", ["user_id"])


@BOOK.add(
    "chk_equality",
    """
    WITH a AS (SELECT o_custkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders),
    b AS (SELECT o_custkey, CASE WHEN o_totalprice > 490000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
                 o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate < '2001-06-01')
    SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
    """,
)
def chk_equality(spark: SparkSession, directory: str) -> DataFrame:
    return compare.equality(*_orders_and_copy(spark, directory))


@BOOK.add("chk_reconciled", BOOK.sql["chk_equality"])
def chk_reconciled(spark: SparkSession, directory: str) -> DataFrame:
    """The same rows, by sums of hashes first."""
    return compare.reconcile(*_orders_and_copy(spark, directory))


def _orders_and_copy(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Orders, a copy that is some weeks old and has other states for large orders, and the columns to compare."""
    day = F.col("o_orderdate").cast("date").alias("day")
    orders = load_table(spark, directory, "orders")
    state = F.when(F.col("o_totalprice") > 490_000, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus")
    copy = orders.filter(F.col("o_orderdate") < "2001-06-01")
    columns = ["o_custkey", "o_orderstatus", "o_orderpriority", "day"]
    return orders.withColumn("day", day), copy.withColumns({"o_orderstatus": state, "day": day}), columns


@BOOK.add(
    "chk_key_bitmaps",
    """
    SELECT 'repeated' AS kind, l_orderkey AS id, count(*) AS n FROM lineitem WHERE l_linenumber > 5 GROUP BY ALL HAVING count(*) > 1
    UNION ALL
    SELECT 'orphan', l_orderkey, count(*) FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < '2001-06-01') GROUP BY ALL
    UNION ALL
    SELECT 'rows', NULL, count(l_orderkey) FROM lineitem
    UNION ALL
    SELECT 'keys', NULL, count(DISTINCT l_orderkey) FROM lineitem
    """,
)
def chk_key_bitmaps(spark: SparkSession, directory: str) -> DataFrame:
    """Order numbers of the lines: repeated ones among the last lines, those without an early order, and their number."""
    lines, orders = load_table(spark, directory, "lineitem"), load_table(spark, directory, "orders")
    repeated = bitmaps.unique(lines.filter("l_linenumber > 5"), "l_orderkey")
    orphans = bitmaps.orphan_counts(lines, "l_orderkey", orders, "o_orderkey", to_condition="o_orderdate < '2001-06-01'")
    totals = bitmaps.distinct_keys(lines, "l_orderkey")
    counts = F.array(
        F.struct(F.lit("rows").alias("kind"), F.col("n_rows").alias("n")), F.struct(F.lit("keys").alias("kind"), F.col("n_keys").alias("n"))
    )
    return (
        repeated.select(F.lit("repeated").alias("kind"), F.col("unique_field").alias("id"), F.col("n_records").alias("n"))
        .unionAll(orphans.select(F.lit("orphan"), "id", "n_rows"))
        .unionAll(totals.select(F.explode(counts).alias("c")).select("c.kind", F.lit(None).cast("bigint"), "c.n"))
    )


@BOOK.add(
    "chk_cardinality_equality",
    """
    WITH a AS (SELECT l_orderkey, count(*) AS num_rows FROM lineitem GROUP BY 1),
    b AS (SELECT o_orderkey, count(*) AS num_rows FROM orders GROUP BY 1)
    SELECT * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
    """,
)
def chk_cardinality_equality(spark: SparkSession, directory: str) -> DataFrame:
    lines, orders = load_table(spark, directory, "lineitem"), load_table(spark, directory, "orders")
    return compare.cardinality_equality(lines, "l_orderkey", orders, "o_orderkey")


_GROUP_COUNTS = """
    WITH a AS (SELECT o_custkey AS party, count(*) AS n FROM orders GROUP BY 1),
    b AS (SELECT user_id AS party, count(*) AS n FROM events GROUP BY 1)
    SELECT coalesce(a.party, b.party) AS party, coalesce(a.n, 0) AS {a}, coalesce(b.n, 0) AS {b}, {delta}
    FROM a FULL JOIN b ON a.party = b.party WHERE {failing}
"""


def _party_tables(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    orders = load_table(spark, directory, "orders").withColumn("party", F.col("o_custkey"))
    events = load_table(spark, directory, "events").withColumn("party", F.col("user_id"))
    return orders, events


@BOOK.add(
    "chk_equal_rowcount",
    _GROUP_COUNTS.format(
        a="count_a",
        b="count_b",
        delta="abs(coalesce(a.n, 0) - coalesce(b.n, 0)) AS diff_count",
        failing="coalesce(a.n, 0) <> coalesce(b.n, 0)",
    ),
)
def chk_equal_rowcount(spark: SparkSession, directory: str) -> DataFrame:
    return compare.equal_rowcount(*_party_tables(spark, directory), ["party"])


@BOOK.add(
    "chk_fewer_rows_than",
    _GROUP_COUNTS.format(
        a="count_our_model",
        b="count_comparison_model",
        delta="CASE WHEN a.n = b.n THEN 1 ELSE a.n - coalesce(b.n, 0) END AS row_count_delta",
        failing="coalesce(a.n, 0) >= coalesce(b.n, 0)",
    ),
)
def chk_fewer_rows_than(spark: SparkSession, directory: str) -> DataFrame:
    return compare.fewer_rows_than(*_party_tables(spark, directory), ["party"])


@BOOK.add(
    "chk_expression_is_true",
    "SELECT * FROM lineitem WHERE NOT (l_extendedprice * (1 - l_discount) >= 250 * l_quantity)",
)
def chk_expression_is_true(spark: SparkSession, directory: str) -> DataFrame:
    lines = load_table(spark, directory, "lineitem")
    return rows.expression_is_true(lines, "* (1 - l_discount) >= 250 * l_quantity", column="l_extendedprice")


@BOOK.add(
    "chk_exclusive_ranges",
    """
    WITH ranges AS (
        SELECT o_custkey AS partition_by_col, CAST(o_orderdate AS DATE) AS lower_bound,
               CAST(o_orderdate + INTERVAL 45 DAY AS DATE) AS upper_bound
        FROM orders
    ), linked AS (
        SELECT *, lead(lower_bound) OVER w AS next_lower_bound,
               row_number() OVER w = count(*) OVER (PARTITION BY partition_by_col) AS is_last_record
        FROM ranges WINDOW w AS (PARTITION BY partition_by_col ORDER BY lower_bound, upper_bound)
    )
    SELECT *, lower_bound < upper_bound AS lower_bound_less_than_upper_bound,
           coalesce(upper_bound <= next_lower_bound, is_last_record)
             AS upper_bound_less_than_or_equal_to_next_lower_bound
    FROM linked
    WHERE NOT (coalesce(lower_bound < upper_bound, FALSE)
               AND coalesce(upper_bound <= next_lower_bound, is_last_record))
    """,
)
def chk_exclusive_ranges(spark: SparkSession, directory: str) -> DataFrame:
    """Customers who order again within 45 days."""
    orders = load_table(spark, directory, "orders")
    day = F.col("o_orderdate").cast("date")
    return ordered.mutually_exclusive_ranges(orders, day, F.date_add(day, 45), partition_by="o_custkey")


_GLOBAL_RANGES = """
    WITH ranges AS (
        SELECT l_orderkey AS lower_bound, l_orderkey + l_linenumber // 7 AS upper_bound FROM lineitem
    ), linked AS (
        SELECT *, lead(lower_bound) OVER w AS next_lower_bound,
               row_number() OVER w = (SELECT count(*) FROM ranges) AS is_last_record
        FROM ranges WINDOW w AS (ORDER BY lower_bound, upper_bound)
    )
    SELECT *, lower_bound <= upper_bound AS lower_bound_less_than_or_equal_to_upper_bound,
           coalesce(upper_bound = next_lower_bound, is_last_record) AS upper_bound_equal_to_next_lower_bound
    FROM linked
    WHERE NOT (coalesce(lower_bound <= upper_bound, FALSE)
               AND coalesce(upper_bound = next_lower_bound, is_last_record))
"""


# Small value ranges, so that the cut into ranges is compared as well.
@BOOK.add("chk_exclusive_ranges_global", _GLOBAL_RANGES)
def chk_exclusive_ranges_global(spark: SparkSession, directory: str) -> DataFrame:
    return ordered.mutually_exclusive_ranges(
        load_table(spark, directory, "lineitem"),
        "l_orderkey",
        "l_orderkey + l_linenumber div 7",
        gaps="not_allowed",
        zero_length_range_allowed=True,
    )


@BOOK.add(
    "chk_not_accepted_values",
    """
    SELECT DISTINCT o_orderpriority AS value_field FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED', 'none')
    """,
)
def chk_not_accepted_values(spark: SparkSession, directory: str) -> DataFrame:
    orders = load_table(spark, directory, "orders")
    return rows.not_accepted_values(orders, "o_orderpriority", ["1-URGENT", "4-NOT SPECIFIED", "none"])


@BOOK.add(
    "chk_not_constant",
    """
    SELECT l_orderkey, count(DISTINCT l_returnflag) AS filler_column FROM lineitem
    GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1
    """,
)
def chk_not_constant(spark: SparkSession, directory: str) -> DataFrame:
    return groups.not_constant(load_table(spark, directory, "lineitem"), "l_returnflag", ["l_orderkey"])


@BOOK.add(
    "chk_not_empty_string",
    with_tables(["src_products"], "SELECT Color FROM src_products WHERE Color = ''"),
)
def chk_not_empty_string(spark: SparkSession, directory: str) -> DataFrame:
    """Empty colors, written as white space."""
    products = sales_sources(spark, directory)["src_products"]
    spaced = products.withColumn("Color", F.concat(F.lit("\t "), "Color", F.lit(" \n")))
    return rows.not_empty_string(spaced, "Color")


@BOOK.add(
    "chk_not_null_proportion",
    """
    SELECT user_id, round(share, 6) AS not_null_proportion
    FROM (SELECT user_id, count(CASE WHEN value >= 20 THEN value END) / count(*) AS share FROM events GROUP BY 1)
    WHERE share < 0.6 OR share > 0.75
    """,
)
def chk_not_null_proportion(spark: SparkSession, directory: str) -> DataFrame:
    events = load_table(spark, directory, "events").withColumn(
        "large", F.when(F.col("value") >= 20, F.col("value"))
    )
    found = groups.not_null_proportion(events, "large", 0.6, 0.75, ["user_id"])
    return found.withColumn("not_null_proportion", F.round(F.col("not_null_proportion").cast("double"), 6))


@BOOK.add(
    "chk_recency",
    """
    SELECT user_id, event_type, max(ts) AS most_recent, TIMESTAMP '2024-01-24 00:00:00' AS threshold
    FROM events GROUP BY 1, 2 HAVING max(ts) < TIMESTAMP '2024-01-24 00:00:00'
    """,
)
def chk_recency(spark: SparkSession, directory: str) -> DataFrame:
    """Users who have not done something for a week, at the end of the month."""
    as_of = F.lit("2024-01-31").cast("timestamp_ntz")
    events = load_table(spark, directory, "events")
    found = groups.recency(events, "ts", "day", 7, group_by=["user_id", "event_type"], as_of=as_of)
    return found.withColumn("threshold", F.col("threshold").cast("timestamp_ntz"))


@BOOK.add(
    "chk_relationships_where",
    """
    SELECT l_orderkey AS id FROM lineitem
    WHERE l_returnflag = 'R' AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
    """,
)
def chk_relationships_where(spark: SparkSession, directory: str) -> DataFrame:
    return compare.relationships_where(
        load_table(spark, directory, "lineitem"),
        "l_orderkey",
        load_table(spark, directory, "orders"),
        "o_orderkey",
        from_condition="l_returnflag = 'R'",
        to_condition="o_orderstatus <> 'P'",
    )


@BOOK.add(
    "chk_sequential_values",
    """
    SELECT * FROM (
        SELECT l_orderkey, l_linenumber,
               lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS previous_l_linenumber
        FROM lineitem)
    WHERE l_linenumber <> previous_l_linenumber + 1
    """,
)
def chk_sequential_values(spark: SparkSession, directory: str) -> DataFrame:
    return ordered.sequential_values(
        load_table(spark, directory, "lineitem"), "l_linenumber", group_by=["l_orderkey"]
    )


@BOOK.add(
    "chk_sequential_values_global",
    """
    SELECT * FROM (SELECT l_orderkey, lag(l_orderkey) OVER (ORDER BY l_orderkey) AS previous_l_orderkey
                   FROM lineitem)
    WHERE l_orderkey <> previous_l_orderkey + 1
    """,
)
def chk_sequential_values_global(spark: SparkSession, directory: str) -> DataFrame:
    lines = load_table(spark, directory, "lineitem")
    return ordered.sequential_values(lines, "l_orderkey")


_HOT_LINES = """
    WITH lines AS (
        SELECT CASE WHEN l_orderkey % 3 = 0 THEN -1 ELSE l_suppkey END AS supplier, l_orderkey * 8 + l_linenumber AS line
        FROM lineitem
    )
"""


def _hot_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Lines of which a third belong to one supplier."""
    supplier = F.when(F.col("l_orderkey") % 3 == 0, -1).otherwise(F.col("l_suppkey")).alias("supplier")
    lines = load_table(spark, directory, "lineitem")
    return lines.select(supplier, (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line"))


@BOOK.add(
    "chk_sequential_hot_group",
    _HOT_LINES
    + """
    SELECT * FROM (SELECT supplier, line, lag(line) OVER (PARTITION BY supplier ORDER BY line) AS previous_line FROM lines)
    WHERE line <> previous_line + 1
    """,
)
def chk_sequential_hot_group(spark: SparkSession, directory: str) -> DataFrame:
    return ordered.sequential_values(_hot_lines(spark, directory), "line", group_by=["supplier"], rows_per_range=1_000)


@BOOK.add(
    "chk_exclusive_ranges_hot_group",
    _HOT_LINES
    + """
    , linked AS (
        SELECT supplier AS partition_by_col, line AS lower_bound, line + 2 AS upper_bound, lead(line) OVER w AS next_lower_bound,
               row_number() OVER w = count(*) OVER (PARTITION BY supplier) AS is_last_record
        FROM lines WINDOW w AS (PARTITION BY supplier ORDER BY line)
    )
    SELECT *, lower_bound < upper_bound AS lower_bound_less_than_upper_bound,
           coalesce(upper_bound <= next_lower_bound, is_last_record) AS upper_bound_less_than_or_equal_to_next_lower_bound
    FROM linked
    WHERE NOT (coalesce(lower_bound < upper_bound, FALSE) AND coalesce(upper_bound <= next_lower_bound, is_last_record))
    """,
)
def chk_exclusive_ranges_hot_group(spark: SparkSession, directory: str) -> DataFrame:
    lines = _hot_lines(spark, directory)
    return ordered.mutually_exclusive_ranges(
        lines, "line", F.col("line") + 2, partition_by="supplier", rows_per_range=1_000
    )


@BOOK.add(
    "chk_sequential_timestamps",
    """
    SELECT * FROM (
        SELECT user_id, hour, lag(hour) OVER (PARTITION BY user_id ORDER BY hour) AS previous_hour
        FROM (SELECT user_id, date_trunc('hour', ts) AS hour FROM events))
    WHERE hour <> previous_hour + INTERVAL 1 HOUR
    """,
)
def chk_sequential_timestamps(spark: SparkSession, directory: str) -> DataFrame:
    events = load_table(spark, directory, "events")
    hourly = events.withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return ordered.sequential_values(hourly, "hour", 1, "hour", ["user_id"])


@BOOK.add(
    "chk_unique_combination",
    "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def chk_unique_combination(spark: SparkSession, directory: str) -> DataFrame:
    lines = load_table(spark, directory, "lineitem")
    return groups.unique_combination_of_columns(lines, ["l_orderkey", "l_linenumber"])


@BOOK.add("chk_not_null", with_tables(["header"], "SELECT * FROM header WHERE SalesPersonID IS NULL"))
def chk_not_null(spark: SparkSession, directory: str) -> DataFrame:
    header = _sales(spark, directory, "store_sales_order_header").drop("_sequence", "_internal_sequence")
    return rows.not_null(header, "SalesPersonID")


@BOOK.add(
    "chk_unique",
    with_tables(
        ["detail"],
        """
        SELECT SalesOrderDetailID AS unique_field, count(*) AS n_records FROM detail
        GROUP BY 1 HAVING count(*) > 1
        """,
    ),
)
def chk_unique(spark: SparkSession, directory: str) -> DataFrame:
    return groups.unique(_sales(spark, directory, "store_sales_order_detail"), "SalesOrderDetailID")


@BOOK.add(
    "chk_accepted_values",
    """
    SELECT p_type AS value_field, count(*) AS n_records FROM part
    WHERE p_type NOT IN ('SMALL', 'MEDIUM', 'LARGE') GROUP BY 1
    """,
)
def chk_accepted_values(spark: SparkSession, directory: str) -> DataFrame:
    return rows.accepted_values(load_table(spark, directory, "part"), "p_type", ["SMALL", "MEDIUM", "LARGE"])


@BOOK.add(
    "chk_custom_query",
    """
    SELECT event_id, user_id, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 10 DAY AND event_type = 'purchase' AND value < 10
    """,
)
def chk_custom_query(spark: SparkSession, directory: str) -> DataFrame:
    """Tiny purchases of the last ten days of the month."""
    return schema.custom_query(
        spark,
        """
        SELECT event_id, user_id, value FROM {events}
        WHERE ts >= (SELECT begin_date FROM {tmp_variable}) AND event_type = 'purchase' AND value < 10
        """,
        {"events": load_table(spark, directory, "events")},
        days_behind=10,
        as_of=F.lit("2024-01-31").cast("timestamp_ntz"),
    )


@BOOK.add(
    "chk_line_total",
    with_tables(
        ["gold_orders"],
        """
        SELECT * EXCLUDE (wrong) REPLACE (wrong AS TotalLineExtendedPrice) FROM (
            SELECT *, CASE WHEN OrderQty > 45 THEN OrderQty * UnitPrice ELSE TotalLineExtendedPrice END AS wrong
            FROM gold_orders)
        WHERE wrong <> OrderQty * (UnitPrice - UnitPriceDiscount)
        """,
    ),
)
def chk_line_total(spark: SparkSession, directory: str) -> DataFrame:
    """Orders whose large lines forgot the discount."""
    forgotten = F.when(F.col("OrderQty") > 45, F.col("OrderQty") * F.col("UnitPrice"))
    orders = _sales(spark, directory, "publish_orders").withColumn(
        "TotalLineExtendedPrice", forgotten.otherwise(F.col("TotalLineExtendedPrice"))
    )
    return rows.expression_is_true(orders, LINE_TOTAL)


@BOOK.add(
    "chk_order_fk",
    with_tables(
        ["detail", "header"],
        """
        SELECT SalesOrderID AS id FROM detail
        WHERE SalesOrderID NOT IN (SELECT SalesOrderID FROM header WHERE OrderDate >= '1995-03-01')
        """,
    ),
)
def chk_order_fk(spark: SparkSession, directory: str) -> DataFrame:
    """Order lines without an order once the oldest orders are gone."""
    tables = build_layers(sales_sources(spark, directory))
    return compare.relationships_where(
        tables["store_sales_order_detail"],
        "SalesOrderID",
        tables["store_sales_order_header"],
        "SalesOrderID",
        to_condition="OrderDate >= DATE'1995-03-01'",
    )


@BOOK.add(
    "chk_freight",
    with_tables(
        ["gold_orders"],
        """
        SELECT * REPLACE (TotalOrderFreight - 100 AS TotalOrderFreight) FROM gold_orders
        WHERE TotalOrderFreight - 100 < 0
        """,
    ),
)
def chk_freight(spark: SparkSession, directory: str) -> DataFrame:
    """Negative freight after a rebate of 100."""
    orders = _sales(spark, directory, "publish_orders")
    rebated = orders.withColumn("TotalOrderFreight", F.col("TotalOrderFreight") - 100)
    return rows.expression_is_true(rebated, ">= 0", column="TotalOrderFreight")


@BOOK.add(
    "chk_color",
    with_tables(["gold_products"], "SELECT ProductID AS ProductId, NULL::VARCHAR AS Color FROM gold_products WHERE Color = 'N/A'"),
)
def chk_color(spark: SparkSession, directory: str) -> DataFrame:
    products = _sales(spark, directory, "publish_products").select(
        "ProductId", F.nullif(F.col("Color"), F.lit("N/A")).alias("Color")
    )
    return rows.not_null(products, "Color")


@BOOK.add(
    "chk_cost",
    with_tables(
        ["gold_products"],
        """
        SELECT ProductID AS ProductId, StandardCost - 550 AS StandardCost FROM gold_products
        WHERE StandardCost - 550 < 0
        """,
    ),
)
def chk_cost(spark: SparkSession, directory: str) -> DataFrame:
    products = _sales(spark, directory, "publish_products").select(
        "ProductId", (F.col("StandardCost") - 550).alias("StandardCost")
    )
    return rows.accepted_range(products, "StandardCost", min_value=0)


@BOOK.add(
    "chk_assert_equal",
    """
    SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'A') AS actual,
           CASE WHEN l_linestatus = 'F' THEN 'R' ELSE 'N' END AS expected
    FROM lineitem WHERE nullif(l_returnflag, 'A') <> CASE WHEN l_linestatus = 'F' THEN 'R' ELSE 'N' END
    """,
)
def chk_assert_equal(spark: SparkSession, directory: str) -> DataFrame:
    lines = load_table(spark, directory, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif(F.col("l_returnflag"), F.lit("A")).alias("actual"),
        F.when(F.col("l_linestatus") == "F", "R").otherwise("N").alias("expected"),
    )
    return rows.assert_equal(lines, "actual", "expected")


@BOOK.add(
    "chk_columns_match",
    """
    SELECT relation_column, input_column
    FROM (SELECT DISTINCT upper('n_' || p_type) AS relation_column FROM part
          UNION ALL SELECT 'P_BRAND') held
    FULL JOIN (SELECT unnest(['P_BRAND', 'N_SMALL', 'N_MEDIUM', 'N_LARGE', 'N_HUGE']) AS input_column) asked
      ON relation_column = input_column
    WHERE relation_column IS NULL OR input_column IS NULL
    """,
)
def chk_columns_match(spark: SparkSession, directory: str) -> DataFrame:
    """Columns that a pivot on the part types found in the data gives, against a list."""
    part = load_table(spark, directory, "part")
    types = introspect.column_value_list(part, "p_type")
    counts = pivot(part, ["p_brand"], "p_type", types, prefix="n_", quote_identifiers=False)
    return schema.expect_table_columns_to_match_set(
        counts, ["p_brand", "n_small", "n_medium", "n_large", "n_huge"]
    )


@BOOK.add(
    "chk_constraints",
    with_tables(
        ["detail", "header", "products"],
        """
        SELECT 'not_null_SalesOrderDetailID' AS check_name,
               (SELECT count(*) FROM detail WHERE SalesOrderDetailID IS NULL) AS failures
        UNION ALL SELECT 'unique_SalesOrderDetailID',
               (SELECT count(*) FROM (SELECT 1 FROM detail GROUP BY SalesOrderDetailID HAVING count(*) > 1))
        UNION ALL SELECT 'relationships_SalesOrderID',
               (SELECT count(*) FROM detail WHERE SalesOrderID NOT IN (SELECT SalesOrderID FROM header))
        UNION ALL SELECT 'relationships_ProductID',
               (SELECT count(*) FROM detail
                WHERE ProductID NOT IN (SELECT ProductID FROM products WHERE ListPrice < 1000))
        """,
    ),
)
def chk_constraints(spark: SparkSession, directory: str) -> DataFrame:
    """Keys of the order lines; only cheap products count as known."""
    tables = build_layers(sales_sources(spark, directory))
    known = tables["store_products"].filter("ListPrice < 1000")
    report = runner.run_checks(
        tables["store_sales_order_detail"],
        [
            *runner.primary_key("SalesOrderDetailID"),
            runner.relationships("SalesOrderID", tables["store_sales_order_header"], "SalesOrderID"),
            runner.relationships("ProductID", known, "ProductId"),
        ],
    )
    return report.select("check_name", "failures")


@BOOK.add(
    "chk_report",
    """
    WITH archive AS (SELECT * FROM orders WHERE o_orderdate < '2001-06-01'), counts AS (
        SELECT 'price_range' AS check_name, 'error' AS severity, 'sales' AS owner,
               (SELECT count(*) FROM orders WHERE NOT (o_totalprice >= 2000)) AS failures
        UNION ALL SELECT 'urgent_price', 'warn', NULL,
               (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT' AND NOT (o_totalprice >= 2000))
        UNION ALL SELECT 'not_null_o_custkey', 'warn', NULL,
               (SELECT count(*) FROM orders WHERE o_custkey IS NULL)
        UNION ALL SELECT 'unique_o_custkey', 'error', NULL,
               (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1))
        UNION ALL SELECT 'fewer_than_lines', 'error', NULL,
               CASE WHEN (SELECT count(*) FROM orders) < (SELECT count(*) FROM lineitem) THEN 0
                    ELSE greatest((SELECT count(*) FROM orders) - (SELECT count(*) FROM lineitem), 1) END
        UNION ALL SELECT 'same_as_archive', 'warn', NULL, extra + missing + abs(extra - missing)
        FROM (SELECT (SELECT count(*) FROM (SELECT * FROM orders EXCEPT SELECT * FROM archive)) AS extra,
                     (SELECT count(*) FROM (SELECT * FROM archive EXCEPT SELECT * FROM orders)) AS missing)
    )
    SELECT *, CASE check_name WHEN 'price_range' THEN CASE WHEN failures > 1000000 THEN 'fail'
                                                          WHEN failures > 0 THEN 'warn' ELSE 'pass' END
                              WHEN 'fewer_than_lines' THEN CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END
                              WHEN 'unique_o_custkey' THEN CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END
                              ELSE CASE WHEN failures > 0 THEN 'warn' ELSE 'pass' END END AS status
    FROM counts
    """,
)
def chk_report(spark: SparkSession, directory: str) -> DataFrame:
    """Checks with filters, thresholds, owners and failure counts of their own."""
    orders = load_table(spark, directory, "orders")
    lines = load_table(spark, directory, "lineitem")
    archive = orders.filter(F.col("o_orderdate") < "2001-06-01")
    price = runner.accepted_range("o_totalprice", min_value=2000)
    return runner.run_checks(
        orders,
        [
            price.configured(name="price_range", severity="error", error_if="> 1000000", owner="sales"),
            price.configured(name="urgent_price", where="o_orderpriority = '1-URGENT'"),
            runner.not_null("o_custkey"),
            runner.unique("o_custkey", severity="error"),
            runner.fewer_rows_than("fewer_than_lines", lines, severity="error"),
            runner.equality("same_as_archive", archive),
        ],
    )
