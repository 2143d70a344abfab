"""The three raw sales sources, derived from order tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sources.files import load_table
from stratalake.sources.schemas import SOURCE_COLUMNS

# The subcategory of a product, by the last digit of its key.
SUBCATEGORIES = [
    "Road Frames",
    "Gloves",
    "Locks",
    "Wheels",
    "Other",
    "Mountain Frames",
    "Helmets",
    "Socks",
    "Saddles",
    "Pumps",
]


def _text(value: Column) -> Column:
    return value.cast("string")


def _day(value: Column) -> Column:
    return F.date_format(value.cast("date"), "yyyy-MM-dd")


def src_products(part: DataFrame) -> DataFrame:
    """Every third product has an empty category and every 13th comes twice, once without one."""
    key, size, price = F.col("p_partkey"), F.col("p_size"), F.col("p_retailprice")
    category = F.when(key % 3 == 0, "").otherwise(F.col("p_type"))
    versions = F.when(key % 13 == 0, F.array(F.lit(""), category)).otherwise(F.array(category))
    subcategory = F.element_at(F.array(*[F.lit(s) for s in SUBCATEGORIES]), (key % 10 + 1).cast("int"))
    return part.select(
        _text(key).alias("ProductID"),
        F.col("p_name").alias("ProductDesc"),
        F.col("p_brand").alias("ProductNumber"),
        _text(size % 2 == 0).alias("MakeFlag"),
        F.when(key % 11 == 0, "").otherwise(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("Color"),
        _text(size * 10).alias("SafetyStockLevel"),
        _text(size * 5).alias("ReorderPoint"),
        _text(price * 0.6).alias("StandardCost"),
        _text(price).alias("ListPrice"),
        _text(size).alias("Size"),
        F.lit("CM").alias("SizeUnitMeasureCode"),
        _text(size * 2).alias("Weight"),
        F.lit("LB").alias("WeightUnitMeasureCode"),
        F.explode(versions).alias("ProductCategoryName"),
        subcategory.alias("ProductSubCategoryName"),
    ).select(*SOURCE_COLUMNS["src_products"])


def src_sales_order_header(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Every tenth order date lacks its day; the ship date is that of the last line."""
    key = F.col("o_orderkey")
    shipped = lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("_shipped"))
    ordered = F.col("o_orderdate")
    return orders.join(shipped, key == F.col("l_orderkey"), "left").select(
        _text(key).alias("SalesOrderID"),
        F.when(key % 10 == 0, F.date_format(ordered.cast("date"), "yyyy-MM"))
        .otherwise(_day(ordered))
        .alias("OrderDate"),
        _day(F.coalesce("_shipped", ordered)).alias("ShipDate"),
        _text(F.col("o_orderstatus") == "O").alias("OnlineOrderFlag"),
        F.concat(F.lit("A"), _text(F.col("o_custkey"))).alias("AccountNumber"),
        _text(F.col("o_custkey")).alias("CustomerID"),
        F.when(key % 3 == 0, "").otherwise(_text(F.col("o_custkey") % 17)).alias("SalesPersonID"),
        _text(F.floor(F.col("o_totalprice") * 2) / 100).alias("Freight"),
    )


def src_sales_order_detail(lineitem: DataFrame) -> DataFrame:
    """Every fourth line of an order has a negative quantity."""
    quantity = F.col("l_quantity").cast("bigint")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return lineitem.select(
        _text(F.col("l_orderkey")).alias("SalesOrderID"),
        _text(F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("SalesOrderDetailID"),
        _text(F.when(F.col("l_linenumber") % 4 == 0, -quantity).otherwise(quantity)).alias("OrderQty"),
        _text(F.col("l_partkey")).alias("ProductID"),
        _text(price).alias("UnitPrice"),
        _text(price * F.col("l_discount")).alias("UnitPriceDiscount"),
    )


def sales_sources(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    part, orders, lineitem = (load_table(spark, directory, t) for t in ("part", "orders", "lineitem"))
    return {
        "src_products": src_products(part),
        "src_sales_order_header": src_sales_order_header(orders, lineitem),
        "src_sales_order_detail": src_sales_order_detail(lineitem),
    }
