"""Declared columns of the three raw sources. Every raw column is text."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Source names and their columns in file order.
SOURCE_COLUMNS = {
    "src_products": [
        "ProductID",
        "ProductDesc",
        "ProductNumber",
        "MakeFlag",
        "Color",
        "SafetyStockLevel",
        "ReorderPoint",
        "StandardCost",
        "ListPrice",
        "Size",
        "SizeUnitMeasureCode",
        "Weight",
        "WeightUnitMeasureCode",
        "ProductCategoryName",
        "ProductSubCategoryName",
    ],
    "src_sales_order_header": [
        "SalesOrderID",
        "OrderDate",
        "ShipDate",
        "OnlineOrderFlag",
        "AccountNumber",
        "CustomerID",
        "SalesPersonID",
        "Freight",
    ],
    "src_sales_order_detail": [
        "SalesOrderID",
        "SalesOrderDetailID",
        "OrderQty",
        "ProductID",
        "UnitPrice",
        "UnitPriceDiscount",
    ],
}


def text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(name, StringType(), True) for name in columns])
