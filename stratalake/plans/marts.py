"""Marts: views over gold.

Both sum up the order lines per product before the product join. Every product
then has one row per group on the line side, so a product that holds much of
the table is no hot join key, and only the sums are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def avg_lead_time_prod_category(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Average lead time per category; lines without a product form the NULL category."""
    per_product = orders.groupBy("ProductID").agg(
        F.sum("LeadTimeInBusinessDays").alias("_days"), F.count("LeadTimeInBusinessDays").alias("_lines")
    )
    category = F.col("ProductCategoryName")
    labels = products.select(
        F.col("ProductId").alias("_product_id"),
        F.when(category == "", "Unknown").otherwise(category).alias("ProductCategoryName"),
    )
    return (
        per_product.join(labels, F.col("ProductID") == F.col("_product_id"), "left")
        .groupBy("ProductCategoryName")
        .agg((F.sum("_days") / F.nullif(F.sum("_lines"), F.lit(0))).alias("AverageLeadTime"))
    )


def color_with_highest_reven_year(orders: DataFrame, products: DataFrame) -> DataFrame:
    """The color, or colors in a tie, with the highest revenue of each year."""
    per_product = orders.groupBy(F.year("OrderDate").cast("bigint").alias("Year"), "ProductID").agg(
        F.sum("TotalLineExtendedPrice").alias("_revenue")
    )
    colors = products.select(F.col("ProductId").alias("_product_id"), "Color")
    revenue = (
        per_product.join(colors, F.col("ProductID") == F.col("_product_id"), "left")
        .groupBy("Year", "Color")
        .agg(F.sum("_revenue").alias("Revenue"))
    )
    # Sums of doubles depend on their order; cents do not, so ties are ties.
    by_revenue = Window.partitionBy("Year").orderBy(F.desc(F.round("Revenue", 2)))
    return revenue.withColumn("_rank", F.rank().over(by_revenue)).filter("_rank = 1").drop("_rank")


# The marts as texts of catalog views over {orders} and {products}.
VIEWS = {
    "avg_lead_time_prod_category": """
        SELECT CASE WHEN p.ProductCategoryName = '' THEN 'Unknown' ELSE p.ProductCategoryName END AS ProductCategoryName,
               sum(o.days) / nullif(sum(o.n_lines), 0) AS AverageLeadTime
        FROM (SELECT ProductID, sum(LeadTimeInBusinessDays) AS days, count(LeadTimeInBusinessDays) AS n_lines
              FROM {orders} GROUP BY ProductID) o
        LEFT JOIN {products} p ON o.ProductID = p.ProductId
        GROUP BY 1
    """,
    "color_with_highest_reven_year": """
        SELECT Year, Color, Revenue
        FROM (SELECT *, rank() OVER (PARTITION BY Year ORDER BY round(Revenue, 2) DESC) AS place
              FROM (SELECT o.Year, p.Color, sum(o.revenue) AS Revenue
                    FROM (SELECT CAST(year(OrderDate) AS BIGINT) AS Year, ProductID, sum(TotalLineExtendedPrice) AS revenue
                          FROM {orders} GROUP BY 1, 2) o
                    LEFT JOIN {products} p ON o.ProductID = p.ProductId
                    GROUP BY 1, 2))
        WHERE place = 1
    """,
}
