"""The whole run: every layer written, checked and read back by the next."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.checks.runner import Check, expression_is_true, not_null, relationships, run_checks, unique
from stratalake.plans import bronze, gold, marts, silver
from stratalake.plans.graph import Model, ModelGraph
from stratalake.sources.layers import (
    layer_path,
    materialize,
    new_version,
    persistent_view,
    publish_view,
    read_layer,
    save_as_table,
    switch_to,
)

# The columns each table is laid out by.
CLUSTER_COLUMNS = {
    "raw_products": ["ProductID"],
    "raw_sales_order_header": ["SalesOrderID"],
    "raw_sales_order_detail": ["SalesOrderDetailID"],
    "store_products": ["ProductId"],
    "store_sales_order_header": ["SalesOrderID"],
    "store_sales_order_detail": ["SalesOrderDetailID", "SalesOrderID", "ProductID"],
    "publish_orders": ["SalesOrderID", "LeadTimeInBusinessDays"],
    "publish_products": ["ProductId", "ProductCategoryName", "ProductSubCategoryName"],
}

LAYERS = ("bronze", "silver", "gold")
LINE_TOTAL = "TotalLineExtendedPrice = OrderQty * (UnitPrice - UnitPriceDiscount)"


def orphan_orders(header: DataFrame) -> Check:
    """Order lines without an order."""
    return relationships("SalesOrderID", header, "SalesOrderID").configured(name="valid_sales_order_id")


def table_checks(tables: Mapping[str, DataFrame]) -> dict[str, list[Check]]:
    """The checks of every table. Those of gold orders look back at the silver tables."""
    order_id, line_id, product_id = "SalesOrderID", "SalesOrderDetailID", "ProductID"
    line_checks = [not_null(line_id), unique(line_id), not_null(order_id), not_null(product_id)]

    def on_silver_lines() -> Check:
        check = orphan_orders(tables["store_sales_order_header"])
        lines = tables["store_sales_order_detail"]
        return check.configured(query=lambda _: check.violations(lines))

    return {
        "raw_products": [not_null(product_id)],
        "raw_sales_order_header": [not_null(order_id), unique(order_id)],
        "raw_sales_order_detail": line_checks,
        "store_products": [not_null("ProductId"), unique("ProductId")],
        "store_sales_order_header": [not_null(order_id), unique(order_id)],
        "store_sales_order_detail": line_checks,
        "publish_orders": [
            not_null(order_id),
            not_null("OrderDate"),
            not_null("ShipDate"),
            expression_is_true("total_line_extended_price", LINE_TOTAL),
            expression_is_true("total_order_freight_non_negative", "TotalOrderFreight >= 0"),
            *([on_silver_lines()] if {"store_sales_order_header", "store_sales_order_detail"} <= set(tables) else []),
        ],
        "publish_products": [
            not_null("ProductId"),
            not_null("Color").configured(name="color_not_null"),
            expression_is_true("standard_cost_non_negative", "StandardCost >= 0"),
        ],
    }


@dataclass(frozen=True)
class LayeredRun:
    tables: dict[str, DataFrame]
    report: DataFrame | None


def _model(layer: str, build: Callable[..., DataFrame], *inputs: str, sample_from: str | None = None) -> Model:
    name = build.__name__
    return Model(name, layer, inputs, build, tuple(CLUSTER_COLUMNS.get(name, ())), layer == "datamart", sample_from)


SALES = ModelGraph(
    [
        _model("bronze", bronze.raw_products, "src_products", sample_from="src_products"),
        _model("bronze", bronze.raw_sales_order_header, "src_sales_order_header"),
        _model("bronze", bronze.raw_sales_order_detail, "src_sales_order_detail"),
        _model("silver", silver.store_products, "raw_products"),
        _model("silver", silver.store_sales_order_header, "raw_sales_order_header"),
        _model("silver", silver.store_sales_order_detail, "raw_sales_order_detail"),
        # The order lines have the order ids of the join, without the join.
        _model(
            "gold",
            gold.publish_orders,
            "store_sales_order_header",
            "store_sales_order_detail",
            sample_from="store_sales_order_detail",
        ),
        _model("gold", gold.publish_products, "store_products"),
        _model("datamart", marts.avg_lead_time_prod_category, "publish_orders", "publish_products"),
        _model("datamart", marts.color_with_highest_reven_year, "publish_orders", "publish_products"),
    ]
)


def build_layers(sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All tables as plans over the sources, nothing written."""
    tables = SALES.plans(sources)
    return {name: table for name, table in tables.items() if not SALES.models[name].is_view}


def publish_catalog(sources: Mapping[str, DataFrame], prefix: str = "") -> dict[str, str]:
    """Gold tables and mart views in the catalog, one database for each layer; returns the names of the marts.

    The marts are persistent views: any session that shares the catalog reads them, and they follow the gold tables.
    """
    tables = build_layers(sources)
    gold_layer, mart_layer = f"{prefix}gold", f"{prefix}datamart"
    for name in ("publish_orders", "publish_products"):
        save_as_table(tables[name], gold_layer, name, CLUSTER_COLUMNS[name])
    names = {"orders": f"`{gold_layer}`.publish_orders", "products": f"`{gold_layer}`.publish_products"}
    spark = tables["publish_orders"].sparkSession
    for name, query in marts.VIEWS.items():
        persistent_view(spark, mart_layer, name, query.format(**names))
    return {name: f"`{mart_layer}`.`{name}`" for name in marts.VIEWS}


class ChecksFailed(RuntimeError):
    """A check of severity error failed; later layers were not built."""


def run_layers(
    sources: Mapping[str, DataFrame],
    root: str,
    checks_of: Callable[[Mapping[str, DataFrame]], dict[str, list[Check]]] = table_checks,
    layers: Sequence[str] = LAYERS,
) -> LayeredRun:
    """Write bronze, silver and gold below ``root`` and publish the marts as views.

    Each layer starts from the files of the layer before, so a failure never goes
    back further than one layer. A layer's checks run once new versions of its tables are
    written; their report is kept below ``<root>/checks``, one row per layer,
    table and check, and a failed check of severity error ends the run. Readers see
    the new versions once the checks of the layer have passed, and the earlier ones until then.

    With fewer ``layers`` only those are built: what they start from is read from
    the files of an earlier run, and the marts are published if gold is among them.
    """
    if not layers or not set(layers) <= set(LAYERS):
        raise ValueError(f"layers must be some of {LAYERS}, got {tuple(layers)}")
    last = max(map(LAYERS.index, layers))
    tables: dict[str, DataFrame] = {}
    reports: list[DataFrame] = []

    def build(layer: str, plans: Mapping[str, DataFrame], samples: Mapping[str, DataFrame] | None = None) -> None:
        if layer not in layers:
            spark = next(iter(plans.values())).sparkSession
            tables.update({name: read_layer(spark, root, layer, name) for name in plans})
            return

        spark = next(iter(plans.values())).sparkSession

        def store(name: str) -> str:
            sample = (samples or {}).get(name)
            return new_version(plans[name], layer_path(root, layer, name), CLUSTER_COLUMNS[name], sample)

        # The tables of a layer do not depend on each other: one fills the cores that another leaves idle.
        with ThreadPoolExecutor(len(plans)) as pool:
            versions = dict(zip(plans, pool.map(store, plans)))
        tables.update({name: spark.read.schema(plans[name].schema).parquet(versions[name]) for name in plans})
        checks = checks_of(tables)
        outcomes = [
            run_checks(tables[name], checks[name]).select(
                F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "*"
            )
            for name in plans
            if checks.get(name)
        ]
        if outcomes:
            report_on(layer, outcomes)
        for name, version in versions.items():
            switch_to(spark, layer_path(root, layer, name), version)

    def report_on(layer: str, outcomes: list[DataFrame]) -> None:
        report = materialize(reduce(DataFrame.unionAll, outcomes), layer_path(root, "checks", layer))
        reports.append(report)
        failed = report.filter("status = 'fail'").select("table_name", "check_name", "failures").collect()
        if failed:
            raise ChecksFailed(f"{layer}: " + ", ".join(f"{t}.{c} ({n})" for t, c, n in failed))

    build(
        "bronze",
        {
            "raw_products": bronze.raw_products(sources["src_products"]),
            "raw_sales_order_header": bronze.raw_sales_order_header(sources["src_sales_order_header"]),
            "raw_sales_order_detail": bronze.raw_sales_order_detail(sources["src_sales_order_detail"]),
        },
        samples={"raw_products": sources["src_products"]},
    )
    if last > 0:
        build(
            "silver",
            {
                "store_products": silver.store_products(tables["raw_products"]),
                "store_sales_order_header": silver.store_sales_order_header(tables["raw_sales_order_header"]),
                "store_sales_order_detail": silver.store_sales_order_detail(tables["raw_sales_order_detail"]),
            },
        )
    if last > 1:
        build(
            "gold",
            {
                "publish_orders": gold.publish_orders(
                    tables["store_sales_order_header"], tables["store_sales_order_detail"]
                ),
                "publish_products": gold.publish_products(tables["store_products"]),
            },
            # The order lines have the order ids of the join, without the join.
            samples={"publish_orders": tables["store_sales_order_detail"]},
        )
        for mart in (marts.avg_lead_time_prod_category, marts.color_with_highest_reven_year):
            tables[mart.__name__] = publish_view(
                mart(tables["publish_orders"], tables["publish_products"]), mart.__name__
            )
    return LayeredRun(tables, reduce(DataFrame.unionAll, reports) if reports else None)
