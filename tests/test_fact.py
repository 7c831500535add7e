from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from saleswh.operators.dedupe import first_row, last_row
from saleswh.operators.joins import fits_broadcast, sum_with_dimension
from saleswh.operators.tables import VersionedTable
from saleswh.plans import dims, fact
from saleswh.plans.pipeline import Warehouse
from tests import builders as b
from tests.conftest import rows


def _by_id(df):
    return {row["order_item_id"]: row for row in df.collect()}


def test_keys_currency_and_amounts(spark):
    found = _by_id(
        fact.fact_rows(
            b.items(spark, (1, 10, 100, 2.0, 9.99), (2, 11, 100, 1.0, 5.0)),
            b.orders(spark, (10, 7, "2024-08-09 14:35:00", "eur"), (11, 8, "2024-08-10 00:01:00", None)),
            b.rates(spark, ("2024-08-09", "EUR", "1.5")),
        )
    )
    assert tuple(found[1])[1:6] == (10, 100, 7, 20240809, 875)
    assert found[1]["currency"] == "EUR" and found[1]["fx_rate_to_usd"] == Decimal("1.50000000")
    assert found[1]["unit_price_usd"] == Decimal("14.9850") and found[1]["line_amount_usd"] == Decimal("29.9700")
    assert found[2]["currency"] == "USD" and found[2]["time_key"] == 1


def test_missing_rate_falls_back_to_one_for_every_currency(spark):
    found = _by_id(
        fact.fact_rows(
            b.items(spark, (1, 10, 1, 1.0, 3.0), (2, 11, 1, 1.0, 3.0), (3, 12, 1, 1.0, 3.0)),
            b.orders(
                spark,
                (10, 7, "2024-08-09 14:35:00", "EUR"),
                (11, 7, "2024-08-10 14:35:00", "EUR"),
                (12, 7, "2024-08-09 14:35:00", "ABC"),
            ),
            b.rates(spark, ("2024-08-09", "EUR", "1.5")),
        )
    )
    assert [str(found[n]["fx_rate_to_usd"]) for n in (1, 2, 3)] == ["1.50000000", "1.00000000", "1.00000000"]


def test_unknown_product_stays_and_unknown_order_goes(spark):
    items = b.items(spark, (1, 10, 999, 1.0, 3.0), (2, 77, 1, 1.0, 3.0))
    orders = b.orders(spark, (10, 7, "2024-08-09 14:35:00", "EUR"))
    assert set(_by_id(fact.fact_rows(items, orders, b.rates(spark, ("2024-08-09", "EUR", "1"))))) == {1}
    known = spark.createDataFrame([(1,)], "product_id long")
    assert set(_by_id(fact.orphan_items(items, known))) == {1}


def test_first_copy_of_an_item_is_kept_in_any_row_order(spark):
    copies = [(1, 10, 5, 2.0, 8.0), (1, 10, 5, 2.0, 7.0), (1, 10, 4, 9.0, 9.0), (2, 10, 5, 1.0, 1.0)]
    orders = b.orders(spark, (10, 7, "2024-08-09 14:35:00", "USD"))
    rates = b.rates(spark, ("2024-08-09", "EUR", "1"))
    expected = None
    for shift in range(4):
        found = rows(fact.fact_rows(b.items(spark, *(copies[shift:] + copies[:shift])), orders, rates))
        assert expected is None or found == expected
        expected = found
    assert [row[2] for row in expected] == [4, 5]


def test_copy_without_an_order_does_not_hide_one_with_an_order(spark):
    items = b.items(spark, (1, 3, 5, 1.0, 8.0), (1, 10, 5, 1.0, 7.0))
    orders = b.orders(spark, (10, 7, "2024-08-09 14:35:00", "USD"))
    found = fact.fact_rows(items, orders, b.rates(spark, ("2024-08-09", "EUR", "1")))
    assert [row["order_id"] for row in found.collect()] == [10]


def test_first_and_last_row_agree_with_brute_force(spark):
    data = [(n % 7, n * 37 % 11, None if n % 5 == 0 else f"v{n % 3}") for n in range(200)]
    df = spark.createDataFrame(data, "k int, o int, v string")

    def rank(row):
        return (row[1], row[2] is not None, row[2] or "")

    groups = {}
    for row in data:
        groups.setdefault(row[0], []).append(row)
    assert rows(first_row(df, ["k"], ["o"])) == sorted((min(g, key=rank) for g in groups.values()), key=repr)
    assert rows(last_row(df, ["k"], ["o"])) == sorted((max(g, key=rank) for g in groups.values()), key=repr)


def test_copies_are_combined_before_the_shuffle(spark):
    """A key with a third of all rows sends one row per task to the shuffle."""
    df = spark.range(0, 90000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    plan = first_row(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning")
    found = {row["k"]: row["v"] for row in first_row(df, ["k"]).collect()}
    assert len(found) == 60001 and found[0] == 0


def test_last_source_row_wins_in_dimensions(spark):
    source = spark.createDataFrame([(1, "B", "x"), (1, "C", "a"), (2, "A", "z")], "id long, name string, category string")
    assert rows(dims.product_rows(source)) == [(1, "C", "a", None), (2, "A", "z", None)]


def test_source_counts_and_categories(spark):
    goods = spark.createDataFrame([(1, "B", "x"), (2, "C", "x")], "id long, name string, category string")
    assert rows(dims.source_counts(products=goods, none=goods.filter("false"))) == [("none", 0), ("products", 2)]
    assert rows(dims.product_categories(goods)) == [("x",)]


def test_sums_are_the_same_whichever_side_is_reduced_first(spark):
    """A product with a third of all sales, an unknown one, and a left join."""
    sales = spark.range(0, 3000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 11).alias("k"),
        (F.col("id") % 5).alias("day"),
        (F.col("id") / 7).cast("decimal(18,4)").alias("amount"),
    )
    dimension = spark.range(1, 9).selectExpr("id AS k", "concat('c', id % 3) AS c")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    results = []
    for threshold in ("100m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            assert fits_broadcast(dimension) is (threshold != "-1")
            results.append(
                [
                    (found.schema, rows(found))
                    for by in (["c"], ["day"], ["c", "day"], [])
                    for how in ("inner", "left")
                    for found in [sum_with_dimension(sales, dimension, "k", by, ["amount"], how)]
                ]
            )
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert results[0] == results[1]
    total = sum(row["amount"] for row in sales.collect())
    assert results[0][7][1] == [(total,)] and results[0][6][1][0][0] < total


def test_small_files_with_many_rows_are_not_broadcast(spark, tmp_path):
    """Keys that follow one another take a byte or two in files and some forty in a broadcast table."""
    spark.range(0, 400_000, 1, 4).selectExpr("id AS k", "concat('c', id % 3) AS c").write.option(
        "compression", "zstd"
    ).parquet(str(tmp_path / "d"))
    dimension = spark.read.parquet(str(tmp_path / "d"))
    assert int(str(dimension._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 10 << 20
    assert not fits_broadcast(dimension.select("k")) and fits_broadcast(dimension.filter("k < 1000"))
    sales = spark.range(0, 900_000, 1, 4).selectExpr("id % 450000 AS k", "CAST(1 AS DECIMAL(18,4)) AS amount")
    found = sum_with_dimension(sales, dimension, "k", ["c"], ["amount"])
    assert sorted((row["c"], int(row["amount"])) for row in found.collect()) == [("c0", 266668), ("c1", 266666), ("c2", 266666)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_numbers_of_a_dimension_are_not_broadcast(spark, tmp_path, monkeypatch):
    plans = []
    real = VersionedTable.replace

    def seen(table, df, *rest, **named):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(table, df, *rest, **named)

    monkeypatch.setattr(VersionedTable, "replace", seen)
    spark.range(0, 50_000, 1, 2).selectExpr("id", "concat('n', id % 9) AS name", "'x' AS category").write.parquet(
        str(tmp_path / "p")
    )
    table = Warehouse(spark, str(tmp_path / "w")).dim_product
    table.create_if_absent()
    dims.upsert_dimension(table, dims.product_rows(spark.read.parquet(str(tmp_path / "p"))), "product_id")
    (plan,) = plans
    assert "BroadcastExchange" not in plan
    assert table.highest() == table.read().select("product_sk").distinct().count() == 50_000
