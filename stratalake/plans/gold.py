"""Gold: business-ready orders and products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.dates import business_days
from stratalake.plans.bronze import PARENT_STAMP, STAMP

# The category of a product without one, by its subcategory.
CLOTHING = ["Gloves", "Shorts", "Socks", "Tights", "Vests"]
ACCESSORIES = ["Locks", "Lights", "Headsets", "Helmets", "Pedals", "Pumps"]
COMPONENTS = ["Wheels", "Saddles"]
COMPONENT_PATTERN = "%Frames%"


def publish_orders(header: DataFrame, detail: DataFrame) -> DataFrame:
    """Order lines with their order, line total and lead time in business days.

    The lead time is computed on the header, which has fewer rows than the lines,
    so one join is enough. A skewed order id is left to the adaptive skew join,
    which splits the line side of a left join.
    """
    orders = header.select(
        F.col("SalesOrderID").alias("_order_id"),
        "OrderDate",
        "ShipDate",
        "OnlineOrderFlag",
        "AccountNumber",
        "CustomerID",
        "SalesPersonID",
        F.col("Freight").alias("TotalOrderFreight"),
        business_days(F.col("OrderDate"), F.col("ShipDate")).alias("LeadTimeInBusinessDays"),
    )
    lines = detail.drop(PARENT_STAMP, STAMP).join(orders, F.col("SalesOrderID") == F.col("_order_id"), "left")
    net_price = F.col("UnitPrice") - F.col("UnitPriceDiscount")
    return lines.select(
        "SalesOrderDetailID",
        "SalesOrderID",
        "OrderQty",
        "ProductID",
        "UnitPrice",
        "UnitPriceDiscount",
        "OrderDate",
        "ShipDate",
        "OnlineOrderFlag",
        "AccountNumber",
        "CustomerID",
        "SalesPersonID",
        "TotalOrderFreight",
        (F.col("OrderQty") * net_price).alias("TotalLineExtendedPrice"),
        "LeadTimeInBusinessDays",
    )


def publish_products(products: DataFrame) -> DataFrame:
    """Products with ``N/A`` for an empty color and a category derived where it is empty."""
    color, category, kind = (F.col(c) for c in ("Color", "ProductCategoryName", "ProductSubCategoryName"))
    derived = (
        F.when(kind.isin(CLOTHING), "Clothing")
        .when(kind.isin(ACCESSORIES), "Accessories")
        .when(kind.like(COMPONENT_PATTERN) | kind.isin(COMPONENTS), "Components")
        .otherwise(category)
    )
    return products.withColumns(
        {
            "Color": F.when(color == "", "N/A").otherwise(color),
            "ProductCategoryName": F.when(category == "", derived).otherwise(category),
        }
    ).drop(PARENT_STAMP, STAMP)
