"""Silver: typed columns. Text that does not fit its type stops the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.plans.bronze import PARENT_STAMP, STAMP

DAY_FORMAT = "yyyy-M-d"


def _typed(name: str, data_type: str) -> Column:
    return F.col(name).cast(data_type).alias(name)


def _stamps() -> list[Column]:
    return [F.col(STAMP).alias(PARENT_STAMP), F.current_timestamp().alias(STAMP)]


def store_products(raw_products: DataFrame) -> DataFrame:
    return raw_products.select(
        F.col("ProductID").cast("bigint").alias("ProductId"),
        "ProductDesc",
        "ProductNumber",
        _typed("MakeFlag", "boolean"),
        "Color",
        _typed("SafetyStockLevel", "bigint"),
        _typed("ReorderPoint", "bigint"),
        _typed("StandardCost", "double"),
        _typed("ListPrice", "double"),
        "Size",
        "SizeUnitMeasureCode",
        "Weight",
        "WeightUnitMeasureCode",
        "ProductCategoryName",
        "ProductSubCategoryName",
        *_stamps(),
    )


def store_sales_order_detail(raw_sales_order_detail: DataFrame) -> DataFrame:
    return raw_sales_order_detail.select(
        _typed("SalesOrderDetailID", "bigint"),
        _typed("SalesOrderID", "bigint"),
        F.abs(F.col("OrderQty").cast("bigint")).alias("OrderQty"),
        _typed("ProductID", "bigint"),
        _typed("UnitPrice", "double"),
        _typed("UnitPriceDiscount", "double"),
        *_stamps(),
    )


def store_sales_order_header(raw_sales_order_header: DataFrame) -> DataFrame:
    """A year and month without a day stand for the first of that month."""
    ordered = F.col("OrderDate")
    month_only = F.rlike(ordered, F.lit(r"^\d{4}-\d{2}$"))
    full_day = F.when(month_only, F.concat(ordered, F.lit("-01"))).otherwise(ordered)
    return raw_sales_order_header.select(
        _typed("SalesOrderID", "bigint"),
        F.to_date(full_day, DAY_FORMAT).alias("OrderDate"),
        F.to_date("ShipDate", DAY_FORMAT).alias("ShipDate"),
        _typed("OnlineOrderFlag", "boolean"),
        "AccountNumber",
        _typed("CustomerID", "bigint"),
        F.nullif(F.col("SalesPersonID"), F.lit("")).cast("bigint").alias("SalesPersonID"),
        _typed("Freight", "double"),
        *_stamps(),
    )
