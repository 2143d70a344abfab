"""Bronze: the raw sources with a load stamp."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators.dedupe import deduplicate
from stratalake.sources.schemas import SOURCE_COLUMNS

STAMP = "_internal_sequence"
PARENT_STAMP = "_sequence"


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn(STAMP, F.current_timestamp())


def raw_products(src_products: DataFrame) -> DataFrame:
    """One row per product, rows with a category first; the other columns settle ties."""
    columns = SOURCE_COLUMNS["src_products"]
    category = F.col("ProductCategoryName")
    without_category = category.isNull() | (category == "")
    order = [without_category, *[F.col(c) for c in columns if c != "ProductID"]]
    return stamped(deduplicate(src_products.select(*columns), ["ProductID"], order))


def raw_sales_order_header(src_sales_order_header: DataFrame) -> DataFrame:
    return stamped(src_sales_order_header.select(*SOURCE_COLUMNS["src_sales_order_header"]))


def raw_sales_order_detail(src_sales_order_detail: DataFrame) -> DataFrame:
    return stamped(src_sales_order_detail.select(*SOURCE_COLUMNS["src_sales_order_detail"]))
