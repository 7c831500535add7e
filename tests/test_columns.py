from __future__ import annotations

import pytest

from saleswh.sources import conform
from saleswh.sources.columns import find_column, resolve_column
from tests.conftest import rows


@pytest.mark.parametrize("columns", [["sku", "label"], ["label", "sku"], ["sku", "label", "extra"]])
def test_order_of_candidates_decides_and_not_that_of_columns(columns):
    assert resolve_column(columns, ["part_no", "sku", "label"]) == "sku"
    assert resolve_column(columns, ["label", "sku"]) == "label"
    assert resolve_column(columns, ["LABEL", "label"]) == "label"


def test_error_lists_what_was_tried():
    with pytest.raises(ValueError, match="part_no.*sku"):
        resolve_column(["a"], ["part_no", "sku"])
    assert find_column(["a"], ["b"]) is None


@pytest.mark.parametrize(
    ("columns", "values", "expected"),
    [
        (["id", "name"], (1, "Ann Lee"), (1, None, None, None)),
        (["customer_id", "full_name", "first_name"], (1, "Ann Lee", "X"), (1, "Ann Lee", None, None)),
        (["id", "first_name", "last_name"], (1, "Ann", "Lee"), (1, "Ann Lee", None, None)),
        (["id", "firstname", "email"], (1, "Ann", "a@b.c"), (1, "Ann", "a@b.c", None)),
        (["id", "lastname", "nation"], (1, "Lee", "PT"), (1, "Lee", None, "PT")),
        (["customer_id", "id", "country_code", "nation"], (1, 2, "PT", "X"), (1, None, None, "PT")),
    ],
)
def test_customer_columns(spark, columns, values, expected):
    assert rows(conform.customers(spark.createDataFrame([values], columns))) == [expected]


def test_missing_name_parts_are_skipped(spark):
    df = spark.createDataFrame([(1, None, "Lee"), (2, None, None)], "id int, first_name string, last_name string")
    assert rows(conform.customers(df)) == [(1, "Lee", None, None), (2, "", None, None)]


def test_name_candidates_are_an_argument(spark):
    df = spark.createDataFrame([(1, "Ann Lee")], ["id", "name"])
    assert rows(conform.customers(df, ["full_name", "name"])) == [(1, "Ann Lee", None, None)]


def test_product_description_is_optional(spark):
    short = spark.createDataFrame([(1, "Cup", "Home")], ["product_id", "product_name", "product_category"])
    long = spark.createDataFrame([(1, "Cup", "Home", "blue")], ["id", "name", "category", "details"])
    assert rows(conform.products(short)) == [(1, "Cup", "Home", None)]
    assert rows(conform.products(long)) == [(1, "Cup", "Home", "blue")]


def test_order_and_item_names(spark):
    orders = spark.sql(
        "SELECT 1 AS id, 2 AS cust_id, TIMESTAMP_NTZ '2024-01-02 03:04:05' AS order_date, "
        "TIMESTAMP_NTZ '2020-01-01 00:00:00' AS created_at, 'EUR' AS currency_code"
    )
    assert str(rows(conform.orders(orders))[0][2]) == "2020-01-01 00:00:00"
    items = spark.sql("SELECT 5 AS id, 1 AS `order`, 9 AS product, 2 AS qty, 1.5D AS unitprice")
    found = conform.order_items(items)
    assert [str(value) for value in found.first()] == ["5", "1", "9", "2.0000", "1.5000"]
    assert found.columns == ["order_item_id", "order_id", "product_id", "quantity", "unit_price_orig"]


def test_text_that_is_no_number_raises(spark):
    items = spark.sql("SELECT 5 AS id, 1 AS order_id, 9 AS product_id, 'two' AS qty, 1.5D AS price")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform.order_items(items).collect()


def test_read_table_formats(spark, tmp_path):
    frame = spark.sql("SELECT 1 AS id, 'Cup' AS name, 'Home' AS category")
    frame.write.option("header", True).csv(str(tmp_path / "csv"))
    frame.write.json(str(tmp_path / "json"))
    frame.write.orc(str(tmp_path / "orc"))
    frame.write.parquet(str(tmp_path / "parquet"))
    for fmt, options in (("csv", {"header": "true"}), ("json", {}), ("orc", {}), ("parquet", {})):
        source = conform.read_table(spark, fmt, str(tmp_path / fmt), **options)
        assert rows(conform.products(source)) == [(1, "Cup", "Home", None)]
