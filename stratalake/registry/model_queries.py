"""Sources, the layer models and the layered run."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.plans import bronze, gold, marts, silver
from stratalake.plans.bronze import PARENT_STAMP, STAMP
from stratalake.plans.layered_run import CLUSTER_COLUMNS, SALES, build_layers, publish_catalog, run_layers, table_checks
from stratalake.registry.book import QueryBook
from stratalake.registry.sales_sql import with_tables
from stratalake.session import scratch_path
from stratalake.sources.files import load_table, source, typed_load, write_text_csv
from stratalake.sources.layers import layer_path, materialize, new_version, read_layer, save_bucketed, switch_to, write_table
from stratalake.sources.sales import sales_sources
from stratalake.sources.zones import overlapping_files, read_range, read_zone_map, write_zone_map

BOOK = QueryBook()


def _unstamped(df: DataFrame) -> DataFrame:
    return df.drop(STAMP, PARENT_STAMP)


def _amounts_as_numbers(df: DataFrame, *columns: str) -> DataFrame:
    """Text amounts as doubles: two engines may print the same double differently."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


_PRODUCT_TEXT = """
    SELECT CAST(ProductID AS VARCHAR) AS ProductID, ProductDesc, ProductNumber,
           CAST(MakeFlag AS VARCHAR) AS MakeFlag, Color,
           CAST(SafetyStockLevel AS VARCHAR) AS SafetyStockLevel, CAST(ReorderPoint AS VARCHAR) AS ReorderPoint,
           StandardCost, ListPrice, Size, SizeUnitMeasureCode, Weight, WeightUnitMeasureCode,
           ProductCategoryName, ProductSubCategoryName
    FROM {table}
"""


@BOOK.add("csv_ingest", with_tables(["src_products"], _PRODUCT_TEXT.format(table="src_products")))
def csv_ingest(spark: SparkSession, directory: str) -> DataFrame:
    folder = scratch_path(spark, "csv")
    write_text_csv(sales_sources(spark, directory)["src_products"], f"{folder}/src_products.csv")
    return _amounts_as_numbers(source(spark, folder, "src_products"), "StandardCost", "ListPrice")


@BOOK.add(
    "typed_load",
    """
    SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice,
           CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
    FROM orders
    """,
)
def typed_csv_load(spark: SparkSession, directory: str) -> DataFrame:
    orders = load_table(spark, directory, "orders")
    path = scratch_path(spark, "typed") + "/orders.csv"
    write_text_csv(
        orders.withColumns(
            {
                "o_orderstatus": F.nullif(F.col("o_orderstatus"), F.lit("P")),
                "o_orderdate": F.col("o_orderdate").cast("date"),
            }
        ),
        path,
    )
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderdate": "date"}
    return typed_load(spark, path, orders.columns, types)


@BOOK.add("bronze_products", with_tables(["products"], _PRODUCT_TEXT.format(table="products")))
def bronze_products(spark: SparkSession, directory: str) -> DataFrame:
    raw = bronze.raw_products(sales_sources(spark, directory)["src_products"])
    return _amounts_as_numbers(_unstamped(raw), "StandardCost", "ListPrice")


@BOOK.add(
    "bronze_order_detail",
    with_tables(
        ["src_detail"],
        """
        SELECT CAST(SalesOrderID AS VARCHAR) AS SalesOrderID,
               CAST(SalesOrderDetailID AS VARCHAR) AS SalesOrderDetailID,
               CAST(OrderQty AS VARCHAR) AS OrderQty, CAST(ProductID AS VARCHAR) AS ProductID, UnitPrice,
               UnitPriceDiscount
        FROM src_detail
        """,
    ),
)
def bronze_order_detail(spark: SparkSession, directory: str) -> DataFrame:
    raw = bronze.raw_sales_order_detail(sales_sources(spark, directory)["src_sales_order_detail"])
    return _amounts_as_numbers(_unstamped(raw), "UnitPrice", "UnitPriceDiscount")


@BOOK.add(
    "bronze_order_header",
    with_tables(
        ["src_header"],
        """
        SELECT CAST(SalesOrderID AS VARCHAR) AS SalesOrderID, OrderDate, ShipDate,
               CAST(OnlineOrderFlag AS VARCHAR) AS OnlineOrderFlag, AccountNumber,
               CAST(CustomerID AS VARCHAR) AS CustomerID, SalesPersonID, Freight
        FROM src_header
        """,
    ),
)
def bronze_order_header(spark: SparkSession, directory: str) -> DataFrame:
    raw = bronze.raw_sales_order_header(sales_sources(spark, directory)["src_sales_order_header"])
    return _amounts_as_numbers(_unstamped(raw), "Freight")


@BOOK.add(
    "silver_products",
    with_tables(["products"], "SELECT * RENAME (ProductID AS ProductId) FROM products"),
)
def silver_products(spark: SparkSession, directory: str) -> DataFrame:
    raw = bronze.raw_products(sales_sources(spark, directory)["src_products"])
    return _unstamped(silver.store_products(raw))


@BOOK.add("silver_order_detail", with_tables(["detail"], "SELECT * FROM detail"))
def silver_order_detail(spark: SparkSession, directory: str) -> DataFrame:
    raw = bronze.raw_sales_order_detail(sales_sources(spark, directory)["src_sales_order_detail"])
    return _unstamped(silver.store_sales_order_detail(raw))


@BOOK.add("silver_order_header", with_tables(["header"], "SELECT * FROM header"))
def silver_order_header(spark: SparkSession, directory: str) -> DataFrame:
    raw = bronze.raw_sales_order_header(sales_sources(spark, directory)["src_sales_order_header"])
    return _unstamped(silver.store_sales_order_header(raw))


@BOOK.add("gold_orders", with_tables(["gold_orders"], "SELECT * FROM gold_orders"))
def gold_orders(spark: SparkSession, directory: str) -> DataFrame:
    return build_layers(sales_sources(spark, directory))["publish_orders"]


@BOOK.add("gold_orders_bucketed", with_tables(["gold_orders"], "SELECT * FROM gold_orders"))
def gold_orders_bucketed(spark: SparkSession, directory: str) -> DataFrame:
    """Gold orders from silver tables that are dealt by order: the join needs no shuffle."""
    layer = f"silver_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE `{layer}` LOCATION '{scratch_path(spark, 'silver')}'")
    silver_tables = build_layers(sales_sources(spark, directory))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    header, detail = (
        save_bucketed(silver_tables[name], layer, name, "SalesOrderID", buckets)
        for name in ("store_sales_order_header", "store_sales_order_detail")
    )
    return gold.publish_orders(header, detail)


@BOOK.add(
    "gold_products",
    with_tables(["gold_products"], "SELECT * RENAME (ProductID AS ProductId) FROM gold_products"),
)
def gold_products(spark: SparkSession, directory: str) -> DataFrame:
    return build_layers(sales_sources(spark, directory))["publish_products"]


@BOOK.add(
    "mart_avg_lead_time",
    with_tables(
        ["mart_lead"],
        "SELECT ProductCategoryName, round(AverageLeadTime, 6) AS AverageLeadTime FROM mart_lead",
    ),
)
def mart_avg_lead_time(spark: SparkSession, directory: str) -> DataFrame:
    tables = build_layers(sales_sources(spark, directory))
    mart = marts.avg_lead_time_prod_category(tables["publish_orders"], tables["publish_products"])
    return mart.withColumn("AverageLeadTime", F.round("AverageLeadTime", 6))


@BOOK.add(
    "mart_top_color_by_year",
    with_tables(
        ["year_color"],
        """
        SELECT Year, Color, round(Revenue, 2) AS Revenue FROM year_color
        QUALIFY rank() OVER (PARTITION BY Year ORDER BY round(year_color.Revenue, 2) DESC) = 1
        """,
    ),
)
def mart_top_color_by_year(spark: SparkSession, directory: str) -> DataFrame:
    tables = build_layers(sales_sources(spark, directory))
    mart = marts.color_with_highest_reven_year(tables["publish_orders"], tables["publish_products"])
    return mart.withColumn("Revenue", F.round("Revenue", 2))


@BOOK.add(
    "layer_roundtrip",
    with_tables(["gold_products"], "SELECT * RENAME (ProductID AS ProductId) FROM gold_products"),
)
def layer_roundtrip(spark: SparkSession, directory: str) -> DataFrame:
    root = scratch_path(spark, "layers")
    products = build_layers(sales_sources(spark, directory))["publish_products"]
    write_table(products, layer_path(root, "gold", "publish_products"))
    return read_layer(spark, root, "gold", "publish_products")


@BOOK.add("clustered_write", with_tables(["header"], "SELECT * FROM header"))
def clustered_write(spark: SparkSession, directory: str) -> DataFrame:
    root = scratch_path(spark, "clustered")
    name = "store_sales_order_header"
    header = build_layers(sales_sources(spark, directory))[name]
    return _unstamped(materialize(header, layer_path(root, "silver", name), CLUSTER_COLUMNS[name]))


def _in_catalog(spark: SparkSession, directory: str) -> dict[str, str]:
    """The marts of a new catalog, in databases of their own."""
    prefix = f"run_{uuid.uuid4().hex}_"
    for layer in ("gold", "datamart"):
        spark.sql(f"CREATE DATABASE `{prefix}{layer}` LOCATION '{scratch_path(spark, layer)}'")
    return publish_catalog(sales_sources(spark, directory), prefix)


@BOOK.add("mart_view_avg_lead_time", BOOK.sql["mart_avg_lead_time"])
def mart_view_avg_lead_time(spark: SparkSession, directory: str) -> DataFrame:
    """The mart as another session reads it from the catalog."""
    mart = spark.newSession().table(_in_catalog(spark, directory)["avg_lead_time_prod_category"])
    return mart.withColumn("AverageLeadTime", F.round("AverageLeadTime", 6))


@BOOK.add("mart_view_top_color", BOOK.sql["mart_top_color_by_year"])
def mart_view_top_color(spark: SparkSession, directory: str) -> DataFrame:
    mart = spark.newSession().table(_in_catalog(spark, directory)["color_with_highest_reven_year"])
    return mart.withColumn("Revenue", F.round("Revenue", 2))


@BOOK.add(
    "graph_run",
    with_tables(
        ["products", "gold_orders", "gold_products"],
        """
        SELECT 1 AS level, 'bronze' AS layer, 'raw_products' AS model, count(*) AS n_rows FROM products
        UNION ALL SELECT 1, 'bronze', 'raw_sales_order_header', count(*) FROM orders
        UNION ALL SELECT 1, 'bronze', 'raw_sales_order_detail', count(*) FROM lineitem
        UNION ALL SELECT 2, 'silver', 'store_products', count(*) FROM products
        UNION ALL SELECT 2, 'silver', 'store_sales_order_header', count(*) FROM header
        UNION ALL SELECT 2, 'silver', 'store_sales_order_detail', count(*) FROM detail
        UNION ALL SELECT 3, 'gold', 'publish_orders', count(*) FROM gold_orders
        UNION ALL SELECT 3, 'gold', 'publish_products', count(*) FROM gold_products
        """,
    ),
)
def graph_run(spark: SparkSession, directory: str) -> DataFrame:
    """The models that a mart is built from, in the order in which they were run, with their rows."""
    root = scratch_path(spark, "graph")
    tables = SALES.run(sales_sources(spark, directory), root, ["+publish_orders", "+publish_products"], table_checks)
    states = read_layer(spark, root, "runs", "states").filter("state = 'done'").select("level", "layer", "model")
    counts = [t.agg(F.lit(n).alias("of"), F.count(F.lit(1)).alias("n_rows")) for n, t in tables.items()]
    return states.join(reduce(DataFrame.unionAll, counts), F.col("model") == F.col("of")).drop("of")


def _zoned_orders(spark: SparkSession, directory: str) -> str:
    """Orders laid out by their key in some files, with a zone map; returns the table's path."""
    path = layer_path(scratch_path(spark, "zones"), "silver", "orders")
    orders = load_table(spark, directory, "orders")
    switch_to(spark, path, new_version(orders, path, ["o_orderkey"]))
    write_zone_map(spark, path, "o_orderkey")
    return path


@BOOK.add(
    "zone_map_overlaps",
    """
    SELECT count(*) AS n_rows, min(o_orderkey) AS least, max(o_orderkey) AS greatest, CAST(0 AS BIGINT) AS overlapping_files
    FROM orders
    """,
)
def zone_map_overlaps(spark: SparkSession, directory: str) -> DataFrame:
    zones = read_zone_map(spark, _zoned_orders(spark, directory), "o_orderkey")
    ends = zones.agg(F.sum("n_rows").alias("n_rows"), F.min("least").alias("least"), F.max("greatest").alias("greatest"))
    overlaps = overlapping_files(zones).agg(F.count(F.lit(1)).alias("overlapping_files"))
    return ends.withColumn("overlapping_files", F.coalesce(overlaps.scalar(), F.lit(0)).cast("bigint"))


@BOOK.add(
    "zone_map_range",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, TRUE AS in_fewer_files
    FROM orders
    WHERE o_orderkey BETWEEN (SELECT max(o_orderkey) FROM orders) // 4 AND (SELECT max(o_orderkey) FROM orders) // 3
    """,
)
def zone_map_range(spark: SparkSession, directory: str) -> DataFrame:
    path = _zoned_orders(spark, directory)
    zones = read_zone_map(spark, path, "o_orderkey")
    greatest, files = zones.agg(F.max("greatest"), F.count(F.lit(1))).first()
    chosen = read_range(spark, path, "o_orderkey", greatest // 4, greatest // 3)
    fewer = F.lit(len(chosen.inputFiles()) <= max(1, files // 2))
    return chosen.select("o_orderkey", "o_custkey", "o_totalprice", fewer.alias("in_fewer_files"))


def _count(condition: str, table: str) -> str:
    return f"(SELECT count(*) FROM {table} WHERE {condition})"


def _repeated(column: str, table: str) -> str:
    return (
        f"(SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL"
        f" GROUP BY 1 HAVING count(*) > 1))"
    )


def _report_sql() -> str:
    """The check report written out: one row per layer, table and check."""
    rows: list[tuple[str, str, str, str]] = []

    def line_checks(layer: str, name: str, table: str) -> None:
        rows.append((layer, name, "not_null_SalesOrderDetailID", _count("SalesOrderDetailID IS NULL", table)))
        rows.append((layer, name, "unique_SalesOrderDetailID", _repeated("SalesOrderDetailID", table)))
        rows.append((layer, name, "not_null_SalesOrderID", _count("SalesOrderID IS NULL", table)))
        rows.append((layer, name, "not_null_ProductID", _count("ProductID IS NULL", table)))

    def header_checks(layer: str, name: str, table: str) -> None:
        rows.append((layer, name, "not_null_SalesOrderID", _count("SalesOrderID IS NULL", table)))
        rows.append((layer, name, "unique_SalesOrderID", _repeated("SalesOrderID", table)))

    rows.append(("bronze", "raw_products", "not_null_ProductID", _count("ProductID IS NULL", "products")))
    header_checks("bronze", "raw_sales_order_header", "src_header")
    line_checks("bronze", "raw_sales_order_detail", "src_detail")
    rows.append(("silver", "store_products", "not_null_ProductId", _count("ProductID IS NULL", "products")))
    rows.append(("silver", "store_products", "unique_ProductId", _repeated("ProductID", "products")))
    header_checks("silver", "store_sales_order_header", "header")
    line_checks("silver", "store_sales_order_detail", "detail")
    for column in ("SalesOrderID", "OrderDate", "ShipDate"):
        rows.append(("gold", "publish_orders", f"not_null_{column}", _count(f"{column} IS NULL", "gold_orders")))
    rows.append(
        (
            "gold",
            "publish_orders",
            "total_line_extended_price",
            _count("TotalLineExtendedPrice <> OrderQty * (UnitPrice - UnitPriceDiscount)", "gold_orders"),
        )
    )
    rows.append(
        ("gold", "publish_orders", "total_order_freight_non_negative", _count("TotalOrderFreight < 0", "gold_orders"))
    )
    rows.append(
        (
            "gold",
            "publish_orders",
            "valid_sales_order_id",
            "(SELECT count(*) FROM detail d ANTI JOIN header h ON d.SalesOrderID = h.SalesOrderID)",
        )
    )
    for check, condition in (
        ("not_null_ProductId", "ProductID IS NULL"),
        ("color_not_null", "Color IS NULL"),
        ("standard_cost_non_negative", "StandardCost < 0"),
    ):
        rows.append(("gold", "publish_products", check, _count(condition, "gold_products")))
    selects = [
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, '{check}' AS check_name, {count} AS failures"
        for layer, name, check, count in rows
    ]
    return with_tables(
        ["gold_orders", "gold_products"],
        "SELECT *, 'warn' AS severity, CASE WHEN failures <> 0 THEN 'warn' ELSE 'pass' END AS status FROM (\n"
        + "\nUNION ALL ".join(selects)
        + ")",
    )


@BOOK.add("layered_run_report", _report_sql())
def layered_run_report(spark: SparkSession, directory: str) -> DataFrame:
    run = run_layers(sales_sources(spark, directory), scratch_path(spark, "run"))
    return run.report.drop("owner")
