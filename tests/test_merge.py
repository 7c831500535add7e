from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleswh import schema
from saleswh.operators.merge import insert_if_absent, merge_rows
from saleswh.operators.numbering import dense_numbers
from saleswh.operators.tables import VersionedTable
from saleswh.plans import dims, fact, fx
from tests import builders as b
from tests.conftest import rows

FIRST, SECOND = datetime(2024, 3, 1), datetime(2024, 3, 2)


def _kv(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, v string, made int")


def test_merge_inserts_overwrites_and_keeps(spark):
    target = _kv(spark, (1, "a", 1), (2, "b", 1), (3, None, 1))
    updates = _kv(spark, (2, "B", 2), (3, "c", 2), (4, "d", 2))
    found = rows(merge_rows(target, updates, ["k"], kept=["made"]))
    assert found == [(1, "a", 1), (2, "B", 1), (3, "c", 1), (4, "d", 2)]


def test_merge_overwrites_with_null(spark):
    found = merge_rows(_kv(spark, (1, "a", 1)), _kv(spark, (1, None, 2)), ["k"])
    assert rows(found) == [(1, None, 2)]


def test_merge_may_leave_kept_columns_out(spark):
    found = merge_rows(_kv(spark, (1, "a", 7)), _kv(spark, (1, "x", 0), (2, "y", 0)).drop("made"), ["k"], ["made"])
    assert rows(found) == [(1, "x", 7), (2, "y", None)]


def test_merging_twice_changes_nothing(spark):
    target, updates = _kv(spark, (1, "a", 1), (2, "b", 1)), _kv(spark, (2, "B", 2), (4, "d", 2))
    once = merge_rows(target, updates, ["k"], ["made"])
    assert rows(merge_rows(once, updates, ["k"], ["made"])) == rows(once)


def test_insert_if_absent(spark):
    assert rows(insert_if_absent(_kv(spark, (1, "a", 1)), _kv(spark, (1, "x", 2), (2, "y", 2)), ["k"])) == [(2, "y", 2)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_new_numbers_are_dense_and_follow_the_key(spark, partitions):
    keys = spark.range(0, 1000, 1, 5).select((F.col("id") * 7919 % 1000 * 3).alias("k")).repartition(partitions)
    found, last = dense_numbers(keys, "k", "sk", 41)
    assert last == 1041
    assert rows(found.select("sk", "k")) == sorted(((42 + i, 3 * i) for i in range(1000)), key=repr)
    none, last = dense_numbers(keys.filter("k < 0"), "k", "sk", 41)
    assert none.count() == 0 and last == 41


# Tables on disk


@pytest.fixture
def months(spark, tmp_path):
    columns = schema._struct(k=schema.T.IntegerType(), month=schema.T.IntegerType())
    return VersionedTable(spark, str(tmp_path / "t"), columns, "month")


def _months(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, month int")


def test_table_starts_empty_and_typed(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "d"), schema.DIM_PRODUCT).create_if_absent()
    assert table.read().isEmpty()
    assert [f.dataType for f in table.read().schema] == [f.dataType for f in schema.DIM_PRODUCT]
    table.create_if_absent()
    assert table.folders() == []


def test_only_named_partitions_are_replaced(spark, months):
    months.replace(_months(spark, (1, 1), (2, 2), (3, 3)))
    months.replace(_months(spark, (20, 2), (40, 4)), [2, 4])
    assert rows(months.read()) == [(1, 1), (20, 2), (3, 3), (40, 4)]
    assert months.folders() == ["version=1/month=1", "version=1/month=3", "version=2/month=2", "version=2/month=4"]


def test_partition_can_become_empty(spark, months):
    months.replace(_months(spark, (1, 1), (2, 2)))
    months.replace(_months(spark, (2, 1)), [1, 2])
    assert rows(months.read()) == [(2, 1)]
    months.replace(_months(spark).filter("false"), [1])
    assert months.read().isEmpty()


def test_table_can_be_rewritten_from_itself(spark, months):
    months.replace(_months(spark, (1, 1), (2, 2)))
    months.replace(months.read().withColumn("k", F.col("k") * 10))
    assert rows(months.read()) == [(10, 1), (20, 2)]


def test_failed_write_leaves_the_table_as_it_was(spark, months):
    months.replace(_months(spark, (1, 1)))
    broken = _months(spark, (2, 2)).withColumn("k", F.expr("raise_error('no') || '1'").cast("int"))
    with pytest.raises(Exception, match="no"):
        months.replace(broken)
    assert rows(months.read()) == [(1, 1)]
    months.replace(_months(spark, (3, 3)))
    assert rows(months.read()) == [(3, 3)]


def test_old_versions_can_be_removed(spark, months, tmp_path):
    months.replace(_months(spark, (1, 1), (2, 2)))
    months.replace(_months(spark, (20, 2)), [2])
    months.remove_old_versions()
    assert rows(months.read()) == [(1, 1), (20, 2)]
    assert not (tmp_path / "t" / "version=1" / "month=2").exists()
    flat = VersionedTable(spark, str(tmp_path / "f"), schema.DIM_TIME)
    for _ in range(2):
        flat.replace(spark.sql("SELECT 1S AS time_key, 0S AS hour, 1S AS minute"))
    flat.remove_old_versions()
    assert [p.name for p in (tmp_path / "f").glob("version=*")] == ["version=2"]
    assert flat.read().count() == 1


# Dimensions


def _products(spark, *triples):
    return dims.product_rows(spark.createDataFrame(list(triples), "id long, name string, category string"))


def test_dimension_upsert(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "p"), schema.DIM_PRODUCT, "bucket", "product_sk").create_if_absent()
    dims.upsert_dimension(table, _products(spark, (1, "Cup", "Home"), (2, "Pen", "Office")), "product_id")
    before = {row["product_id"]: row for row in table.read().collect()}
    assert len({row["product_sk"] for row in before.values()}) == 2
    second = _products(spark, (2, "Pen", "School"), (3, "Mug", None))
    for _ in range(2):
        dims.upsert_dimension(table, second, "product_id")
        after = {row["product_id"]: row for row in table.read().collect()}
        assert after[1] == before[1]
        assert after[2]["category"] == "School" and after[2]["product_sk"] == before[2]["product_sk"]
        assert table.highest() == after[3]["product_sk"]
        assert after[3]["product_sk"] > max(row["product_sk"] for row in before.values())
        assert len(after) == 3


def test_add_missing_appends_only_new_keys(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), schema.DIM_TIME).create_if_absent()
    minute = "SELECT CAST(id AS SMALLINT) AS time_key, 0S AS hour, CAST(id AS SMALLINT) AS minute FROM range({})"
    for size, folders in ((3, 1), (3, 1), (5, 2)):
        dims.add_missing(table, spark.sql(minute.format(size)), "time_key")
        assert table.read().count() == size and len(table.folders()) == folders


def test_rate_upsert_by_day_and_currency(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "fx"), schema.DIM_FX_RATE, "fx_year").create_if_absent()
    fx.upsert_fx_rates(table, b.rates(spark, ("2024-01-01", "EUR", "1.1"), ("2024-01-02", "EUR", "1.2")))
    fx.upsert_fx_rates(table, b.rates(spark, ("2024-01-02", "EUR", "1.3"), ("2024-01-02", "GBP", "1.4")))
    found = [(row["fx_date"].day, row["currency"], float(row["rate_to_usd"])) for row in table.read().collect()]
    assert sorted(found) == [(1, "EUR", 1.1), (2, "EUR", 1.3), (2, "GBP", 1.4)]


# Facts


def _load(spark, table, moment, *triples):
    """(item id, order timestamp, price)"""
    loaded = fact.fact_rows(
        b.items(spark, *((item, item, 1, 1.0, price) for item, _, price in triples)),
        b.orders(spark, *((item, 1, ts, "USD") for item, ts, _ in triples)),
        b.rates(spark, ("2024-01-01", "EUR", "1")),
    )
    fact.upsert_fact(table, loaded, moment)
    return {row["order_item_id"]: row for row in table.read().collect()}


@pytest.fixture
def facts_table(spark, tmp_path):
    path = str(tmp_path / "fact")
    return VersionedTable(
        spark, path, schema.FACT_STORED, schema.FACT_PARTITION, "sales_item_sk"
    ).create_if_absent()


def test_fact_upsert_keeps_number_and_creation(spark, facts_table):
    first = _load(spark, facts_table, FIRST, (1, "2024-01-05", 1.0), (2, "2024-01-06", 2.0), (3, "2024-02-01", 3.0))
    second = _load(spark, facts_table, SECOND, (2, "2024-01-06", 20.0), (4, "2024-03-01", 4.0))
    assert set(second) == {1, 2, 3, 4}
    assert second[1] == first[1] and second[3] == first[3]
    assert float(second[2]["line_amount_usd"]) == 20.0
    assert second[2]["sales_item_sk"] == first[2]["sales_item_sk"] and second[2]["created_at"] == FIRST
    assert second[4]["created_at"] == SECOND
    assert second[4]["sales_item_sk"] > max(row["sales_item_sk"] for row in first.values())
    assert facts_table.highest() == second[4]["sales_item_sk"]
    folders = facts_table.folders()
    again = _load(spark, facts_table, SECOND, (2, "2024-01-06", 20.0), (4, "2024-03-01", 4.0))
    assert again == second and facts_table.folders() == folders


def test_fact_upsert_leaves_untouched_months_alone(spark, facts_table):
    _load(spark, facts_table, FIRST, (1, "2024-01-05", 1.0), (3, "2024-02-01", 3.0))
    _load(spark, facts_table, SECOND, (4, "2024-02-07", 4.0))
    assert facts_table.folders() == ["version=1/sales_month=202401", "version=2/sales_month=202402"]


def test_fact_that_moves_to_another_month(spark, facts_table):
    first = _load(spark, facts_table, FIRST, (1, "2024-01-05", 1.0), (2, "2024-01-06", 2.0), (3, "2024-02-01", 3.0))
    second = _load(spark, facts_table, SECOND, (2, "2024-04-06", 2.0))
    assert set(second) == {1, 2, 3}
    assert (second[2]["date_key"], second[2]["sales_month"]) == (20240406, 202404)
    assert second[2]["sales_item_sk"] == first[2]["sales_item_sk"]
    assert facts_table.folders() == [
        "version=1/sales_month=202402",
        "version=2/sales_month=202401",
        "version=2/sales_month=202404",
    ]


def test_loading_nothing(spark, facts_table):
    _load(spark, facts_table, FIRST, (1, "2024-01-05", 1.0))
    before = facts_table.folders()
    empty = facts_table.read().filter("false").drop("sales_item_sk", "created_at", "sales_month")
    fact.upsert_fact(facts_table, empty, SECOND)
    assert facts_table.folders() == before and facts_table.read().count() == 1


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(st.integers(0, 20), st.one_of(st.none(), st.text("ab", max_size=2)), max_size=15),
    st.dictionaries(st.integers(0, 20), st.one_of(st.none(), st.text("ab", max_size=2)), max_size=15),
)
def test_merge_equals_a_dictionary_update(spark, old, new):
    def table(values, made):
        return spark.createDataFrame([(k, v, made) for k, v in values.items()], "k int, v string, made int")

    found = {row["k"]: (row["v"], row["made"]) for row in merge_rows(table(old, 1), table(new, 2), ["k"], ["made"]).collect()}
    assert found == {k: ({**old, **new}[k], 1 if k in old else 2) for k in old | new}
