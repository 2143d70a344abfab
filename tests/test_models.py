import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratalake.checks import groups, runner
from stratalake.plans import bronze, gold, marts, silver
from stratalake.plans.layered_run import CLUSTER_COLUMNS, ChecksFailed, build_layers, run_layers, table_checks
from stratalake.session import scratch_path
from stratalake.sources.files import read_text_csv, source, typed_load, write_text_csv
from stratalake.sources.layers import layer_path, read_layer
from stratalake.sources.schemas import SOURCE_COLUMNS, text_schema

PRODUCT = dict(
    ProductID="1",
    ProductDesc="Thing",
    ProductNumber="T-1",
    MakeFlag="true",
    Color="Red",
    SafetyStockLevel="10",
    ReorderPoint="5",
    StandardCost="1.5",
    ListPrice="3",
    Size="M",
    SizeUnitMeasureCode="CM",
    Weight="2",
    WeightUnitMeasureCode="LB",
    ProductCategoryName="Bikes",
    ProductSubCategoryName="Other",
)
HEADER = dict(
    SalesOrderID="10",
    OrderDate="2024-01-05",
    ShipDate="2024-01-08",
    OnlineOrderFlag="false",
    AccountNumber="A1",
    CustomerID="7",
    SalesPersonID="3",
    Freight="12.5",
)
DETAIL = dict(
    SalesOrderID="10", SalesOrderDetailID="100", OrderQty="2", ProductID="1", UnitPrice="10", UnitPriceDiscount="1.5"
)


@pytest.fixture
def make(spark):
    """A raw source from dictionaries of changes to a sample row."""

    def build(name, sample, *changes):
        columns = SOURCE_COLUMNS[name]
        rows = [tuple({**sample, **change}[c] for c in columns) for change in changes]
        return spark.createDataFrame(rows, text_schema(columns))

    return build


def products_from(make, *changes):
    return gold.publish_products(silver.store_products(bronze.raw_products(make("src_products", PRODUCT, *changes))))


def header_from(make, *changes):
    raw = bronze.raw_sales_order_header(make("src_sales_order_header", HEADER, *changes))
    return silver.store_sales_order_header(raw)


def detail_from(make, *changes):
    raw = bronze.raw_sales_order_detail(make("src_sales_order_detail", DETAIL, *changes))
    return silver.store_sales_order_detail(raw)


# --- bronze and silver


def test_bronze_keeps_the_row_with_a_category(make):
    raw = bronze.raw_products(
        make("src_products", PRODUCT, {"ProductCategoryName": ""}, {}, {"ProductID": "2", "ProductCategoryName": None})
    )
    assert {r.ProductID: r.ProductCategoryName for r in raw.collect()} == {"1": "Bikes", "2": None}
    assert raw.columns[-1] == "_internal_sequence"


def test_silver_types_and_stamps(make):
    schema = {f.name: f.dataType.simpleString() for f in silver.store_products(bronze.raw_products(make("src_products", PRODUCT, {}))).schema}
    assert schema["ProductId"] == "bigint" and schema["MakeFlag"] == "boolean" and schema["StandardCost"] == "double"
    assert schema["Size"] == schema["Weight"] == "string"
    assert list(schema)[-2:] == ["_sequence", "_internal_sequence"]
    assert schema["_sequence"] == schema["_internal_sequence"] == "timestamp"


def test_header_dates_and_empty_sales_person(make):
    header = header_from(
        make,
        {"OrderDate": "2021-06", "SalesPersonID": ""},
        {"SalesOrderID": "11", "OrderDate": "2024-1-5"},
    )
    rows = {r.SalesOrderID: r for r in header.collect()}
    assert rows[10].OrderDate == dt.date(2021, 6, 1) and rows[10].SalesPersonID is None
    assert rows[11].OrderDate == dt.date(2024, 1, 5) and rows[11].SalesPersonID == 3


def test_negative_quantity(make):
    assert detail_from(make, {"OrderQty": "-3"}).first().OrderQty == 3


@pytest.mark.parametrize("change", [{"OrderDate": "June"}, {"ShipDate": ""}, {"Freight": "much"}])
def test_malformed_text_stops_the_job(make, change):
    with pytest.raises(PySparkException):
        header_from(make, change).collect()


# --- gold and marts


def test_line_total_and_lead_time(make):
    orders = gold.publish_orders(header_from(make, {}), detail_from(make, {}, {"SalesOrderID": "99"}))
    rows = {r.SalesOrderID: r for r in orders.collect()}
    assert rows[10].TotalLineExtendedPrice == 17.0
    assert rows[10].LeadTimeInBusinessDays == 2 and rows[10].TotalOrderFreight == 12.5
    assert rows[99].OrderDate is None and rows[99].LeadTimeInBusinessDays is None
    assert orders.columns == [
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
        "TotalLineExtendedPrice",
        "LeadTimeInBusinessDays",
    ]


def test_shipped_before_ordered_has_no_lead_time(make):
    orders = gold.publish_orders(header_from(make, {"ShipDate": "2024-01-04"}), detail_from(make, {}))
    assert [r.LeadTimeInBusinessDays for r in orders.collect()] == [None]


def test_colors_and_derived_categories(make):
    kinds = ["Gloves", "Locks", "Mountain Frames", "Wheels", "Other"]
    changes = [
        {"ProductID": str(i), "ProductCategoryName": "", "ProductSubCategoryName": kind} for i, kind in enumerate(kinds)
    ]
    changes += [{"ProductID": "10", "Color": ""}, {"ProductID": "11", "Color": None}]
    products = products_from(make, *changes)
    rows = {r.ProductId: r for r in products.collect()}
    assert [rows[i].ProductCategoryName for i in range(5)] == ["Clothing", "Accessories", "Components", "Components", ""]
    assert rows[10].Color == "N/A" and rows[11].Color is None
    assert rows[10].ProductCategoryName == "Bikes"
    assert "_sequence" not in products.columns and "_internal_sequence" not in products.columns


def test_average_lead_time_has_a_group_without_product(make):
    orders = gold.publish_orders(
        header_from(make, {}, {"SalesOrderID": "11", "ShipDate": "2024-01-05"}),
        detail_from(make, {}, {"SalesOrderID": "11"}, {"ProductID": "2"}, {"ProductID": "77"}),
    )
    products = products_from(make, {}, {"ProductID": "2", "ProductCategoryName": ""})
    mart = marts.avg_lead_time_prod_category(orders, products)
    assert {tuple(r) for r in mart.collect()} == {("Bikes", 1.5), ("Unknown", 2.0), (None, 2.0)}


def test_top_color_keeps_ties(make):
    orders = gold.publish_orders(
        header_from(make, {}, {"SalesOrderID": "11", "OrderDate": "2023-02"}),
        detail_from(make, {}, {"ProductID": "2"}, {"ProductID": "3", "OrderQty": "1"}, {"SalesOrderID": "11"}),
    )
    products = products_from(
        make, {}, {"ProductID": "2", "Color": "Blue"}, {"ProductID": "3", "Color": "Green"}
    )
    mart = marts.color_with_highest_reven_year(orders, products)
    assert {tuple(r) for r in mart.collect()} == {(2024, "Red", 17.0), (2024, "Blue", 17.0), (2023, "Red", 17.0)}


# --- files


def test_csv_source_keeps_empty_text(spark, tmp_path):
    (tmp_path / "src_sales_order_detail.csv").write_text(
        "a,b,c,d,e,f\n1,2,,\"\",\"x, \"\"y\"\"\",é\n", encoding="utf-8"
    )
    df = source(spark, str(tmp_path), "src_sales_order_detail")
    assert df.columns == SOURCE_COLUMNS["src_sales_order_detail"]
    assert tuple(df.first()) == ("1", "2", "", "", 'x, "y"', "é")
    with pytest.raises(KeyError):
        source(spark, str(tmp_path), "src_unknown")


def test_csv_with_a_missing_field_stops_the_job(spark, tmp_path):
    path = tmp_path / "jagged.csv"
    path.write_text("a,b\n1,2\n3\n")
    with pytest.raises(Exception, match="MALFORMED_CSV_RECORD"):
        read_text_csv(spark, str(path), ["a", "b"]).collect()


def test_csv_roundtrip(spark, rows_of):
    rows = [("", "a,b"), ('say "hi"', "back\\slash"), (" padded ", "é")]
    path = scratch_path(spark, "csv")
    write_text_csv(spark.createDataFrame(rows, "x string, y string"), path)
    assert rows_of(read_text_csv(spark, path, ["x", "y"])) == rows


def test_typed_load(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("id,name,day\n1,,2024-01-05\n,b,\n")
    df = typed_load(spark, str(path), ["id", "name", "day"], {"ID": "bigint", "day": "date"})
    assert [tuple(r) for r in df.collect()] == [(1, None, dt.date(2024, 1, 5)), (None, "b", None)]
    inferred = typed_load(spark, str(path), ["id", "name", "day"], {"id": "bigint"}, infer_others=True)
    assert [f.dataType.simpleString() for f in inferred.schema] == ["bigint", "string", "date"]
    assert inferred.collect() == df.collect()
    with pytest.raises(ValueError):
        typed_load(spark, str(path), ["id"], {"nope": "int"})
    path.write_text("id\nx\n")
    with pytest.raises(PySparkException):
        typed_load(spark, str(path), ["id"], {"id": "bigint"}).collect()


def test_layer_path():
    assert layer_path("/data/", "gold", "t") == "/data/gold/t"
    assert layer_path("/data", None, "t") == "/data/default/t"


# --- the whole run


@pytest.fixture
def sources(make):
    return {
        "src_products": make("src_products", PRODUCT, {}, {"ProductID": "2", "Color": None}),
        "src_sales_order_header": make("src_sales_order_header", HEADER, {}, {"SalesOrderID": "11", "Freight": "-1"}),
        "src_sales_order_detail": make(
            "src_sales_order_detail",
            DETAIL,
            {},
            {"SalesOrderID": "11"},
            {"SalesOrderDetailID": "101", "SalesOrderID": "99"},
        ),
    }


def test_run_writes_checks_and_publishes(spark, sources):
    root = scratch_path(spark, "run")
    run = run_layers(sources, root)
    report = {(r.layer, r.table_name, r.check_name): (r.failures, r.status) for r in run.report.collect()}
    assert len(report) == 24
    broken = {key: value for key, value in report.items() if value[1] != "pass"}
    assert broken == {
        ("bronze", "raw_sales_order_detail", "unique_SalesOrderDetailID"): (1, "warn"),
        ("silver", "store_sales_order_detail", "unique_SalesOrderDetailID"): (1, "warn"),
        ("gold", "publish_orders", "not_null_OrderDate"): (1, "warn"),
        ("gold", "publish_orders", "not_null_ShipDate"): (1, "warn"),
        ("gold", "publish_orders", "total_order_freight_non_negative"): (1, "warn"),
        ("gold", "publish_orders", "valid_sales_order_id"): (1, "warn"),
        ("gold", "publish_products", "color_not_null"): (1, "warn"),
    }
    plans = build_layers(sources)
    for name, layer in (("raw_products", "bronze"), ("store_products", "silver"), ("publish_orders", "gold")):
        assert read_layer(spark, root, layer, name).columns == plans[name].columns
    assert spark.table("color_with_highest_reven_year").count() == 2
    assert set(CLUSTER_COLUMNS) == set(plans)


def test_run_again_replaces_the_tables(spark, sources):
    root = scratch_path(spark, "run")
    run_layers(sources, root)
    assert run_layers(sources, root).tables["publish_orders"].count() == 3


def test_run_of_chosen_layers(spark, sources):
    root = scratch_path(spark, "run")
    first = run_layers(sources, root, layers=["bronze", "silver"])
    assert "publish_orders" not in first.tables
    with pytest.raises(PySparkException):
        read_layer(spark, root, "gold", "publish_orders")
    silver_files = sorted(read_layer(spark, root, "silver", "store_products").inputFiles())
    again = run_layers(sources, root, layers=["gold"])
    assert {r.layer for r in again.report.select("layer").distinct().collect()} == {"gold"}
    assert again.tables["publish_orders"].count() == 3
    assert sorted(read_layer(spark, root, "silver", "store_products").inputFiles()) == silver_files
    with pytest.raises(ValueError):
        run_layers(sources, root, layers=["marts"])


def test_run_without_checks(spark, sources):
    run = run_layers(sources, scratch_path(spark, "run"), lambda tables: {})
    assert run.report is None and run.tables["publish_products"].count() == 2


def test_a_failed_check_ends_the_run(spark, sources):
    root = scratch_path(spark, "run")

    def strict(tables):
        checks = table_checks(tables)
        checks["raw_sales_order_detail"] = [runner.unique("SalesOrderDetailID", severity="error")]
        return checks

    with pytest.raises(ChecksFailed, match="unique_SalesOrderDetailID"):
        run_layers(sources, root, strict)
    with pytest.raises(PySparkException):
        read_layer(spark, root, "silver", "store_products")


# --- the runner


def test_report_statuses(spark, table):
    df = table("id int, v int", (1, 1), (2, -1), (3, None), (3, -5))
    negative = runner.accepted_range("v", min_value=0)
    checks = [
        negative.configured(name="warns"),
        negative.configured(name="fails", severity="error"),
        negative.configured(name="filtered", severity="error", where="id < 2"),
        negative.configured(name="tolerated", severity="error", warn_if="> 5", error_if="> 10"),
        negative.configured(name="warned error", severity="error", error_if="> 10"),
        negative.configured(name="expected", severity="error", error_if="< 1", warn_if="< 0"),
        runner.not_null("v", owner="someone"),
        runner.unique("id"),
        runner.fewer_rows_than("fewer", df.limit(1), severity="error"),
        runner.equal_rowcount("same size", df),
        runner.equality("same rows", df.filter("id < 3")),
        runner.relationships("id", df.filter("id < 3"), "id"),
        runner.from_function("constant", groups.not_constant, "v", group_by=["id"], options={"severity": "error"}),
        runner.custom_query("query", "SELECT * FROM {model} WHERE v > 0"),
    ]
    report = {r.check_name: (r.failures, r.status, r.owner) for r in runner.run_checks(df, checks).collect()}
    assert report == {
        "warns": (2, "warn", None),
        "fails": (2, "fail", None),
        "filtered": (0, "pass", None),
        "tolerated": (2, "pass", None),
        "warned error": (2, "warn", None),
        "expected": (2, "pass", None),
        "not_null_v": (1, "warn", "someone"),
        "unique_id": (1, "warn", None),
        "fewer": (3, "fail", None),
        "same size": (0, "pass", None),
        "same rows": (4, "warn", None),
        "relationships_id": (2, "warn", None),
        "constant": (3, "fail", None),
        "query": (1, "warn", None),
    }


def test_predicate_checks_share_one_scan(spark, table):
    df = table("a int, b int", (1, 2))
    checks = [runner.not_null("a"), runner.not_null("b"), runner.accepted_range("a", 0, 5)]
    plan = runner.run_checks(df, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1


def test_violations_are_stored(spark, table, rows_of):
    path = scratch_path(spark, "violations")
    df = table("a int", 1, -1)
    report = runner.run_checks(df, [runner.accepted_range("a", min_value=0, store_as=path)])
    assert report.first().failures == 1
    assert rows_of(spark.read.parquet(path)) == [(-1,)]


def test_wrong_check_definitions(table):
    with pytest.raises(ValueError):
        runner.Check("both", violation="true", query=lambda df: df)
    with pytest.raises(ValueError):
        runner.not_null("a", severity="fatal")
    with pytest.raises(ValueError):
        runner.run_checks(table("a int", 1), [runner.not_null("a"), runner.not_null("a")])
    with pytest.raises(ValueError):
        runner.run_checks(table("a int", 1), [])


def test_primary_key_checks(table):
    report = runner.run_checks(table("k int", 1, 1, None), runner.primary_key("k"))
    assert {r.check_name: r.failures for r in report.collect()} == {"not_null_k": 1, "unique_k": 1}
