from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from saleswh.plans import fx
from saleswh.sources import conform, generators, retail
from saleswh.sources.fx_snapshot import quotes, read_snapshot
from tests import builders as b
from tests.conftest import rows


def _orders(spark, *pairs):
    return spark.createDataFrame(list(pairs), "day string, currency string").select(
        F.col("day").cast("timestamp_ntz").alias("order_timestamp"), "currency"
    )


def test_snapshot_from_json(spark, tmp_path):
    path = tmp_path / "rates.json"
    path.write_text(
        json.dumps({"result": "success", "base_code": "eur", "conversion_rates": {"USD": 1.25, "GBP": 0.5}}, indent=1)
    )
    snapshot = read_snapshot(spark, str(path))
    assert rows(quotes(snapshot)) == [("EUR", "GBP", 0.5), ("EUR", "USD", 1.25)]


@pytest.mark.parametrize("payload", [{"result": "error"}, {"base_code": "USD"}])
def test_snapshot_without_success_is_refused(spark, tmp_path, payload):
    path = tmp_path / "rates.json"
    path.write_text(json.dumps(payload))
    with pytest.raises(ValueError, match="success"):
        read_snapshot(spark, str(path))


def test_snapshot_defaults(spark, tmp_path):
    path = tmp_path / "rates.json"
    path.write_text(json.dumps({"result": "success"}))
    snapshot = read_snapshot(spark, str(path))
    assert snapshot.select("base_code").first()[0] == "USD"
    assert quotes(snapshot).isEmpty()
    currencies = spark.createDataFrame([("EUR",), ("USD",)], "currency string")
    assert {str(r[1]) for r in rows(fx.currency_rates(currencies, snapshot))} == {"1.00000000"}


def test_order_currencies(spark):
    orders = _orders(spark, ("2024-01-01", "usd"), ("2024-01-02", None), ("2024-01-03", "abcdef"))
    assert rows(conform.order_currencies(orders)) == [("ABC",), ("EUR",), ("GBP",), ("USD",)]


def test_rates_are_back_filled_between_the_order_days(spark):
    orders = _orders(spark, ("2024-02-28 23:59:00", "EUR"), ("2024-03-01 00:00:00", "ABC"))
    snapshot = retail.snapshot(spark, "USD", {"EUR": 0.8, "GBP": 0.5})
    found = rows(fx.fx_rate_rows(orders, snapshot, "p", date(2024, 3, 2)))
    assert [(row[0].day, row[1], str(row[2])) for row in sorted(found)] == [
        (day, code, rate)
        for day in (28, 29, 1)
        for code, rate in (("ABC", "1.00000000"), ("EUR", "1.25000000"), ("GBP", "2.00000000"), ("USD", "1.00000000"))
    ]
    assert {row[3] for row in found} == {"p (latest base=USD)"}


def test_rates_for_one_day_only(spark):
    orders = _orders(spark, ("2024-02-28", "EUR"), ("2024-03-01", "EUR"))
    snapshot = retail.snapshot(spark, "EUR", {"USD": 1.25})
    found = rows(fx.fx_rate_rows(orders, snapshot, "p", date(2024, 3, 2), run_date=date(2025, 1, 1)))
    assert {(row[0], row[1], str(row[2]), row[3]) for row in found} == {
        (date(2025, 1, 1), "EUR", "1.00000000", "p (latest base=EUR)"),
        (date(2025, 1, 1), "GBP", "1.00000000", "p (latest base=EUR)"),
        (date(2025, 1, 1), "USD", "1.00000000", "p (latest base=EUR)"),
    }


def test_no_orders_no_rates(spark):
    orders = _orders(spark, ("2024-01-01", "EUR")).filter("false")
    snapshot = retail.snapshot(spark, "USD", {"EUR": 0.8})
    assert fx.fx_rate_rows(orders, snapshot, "p", date(2024, 1, 1)).isEmpty()
    assert rows(conform.order_date_range(orders)) == [(None, None)]


def test_every_day_between_orders_has_rates(spark):
    orders = _orders(spark, ("2024-01-01", "EUR"), ("2024-01-04", "EUR"))
    snapshot = retail.snapshot(spark, "USD", {"EUR": 0.8})
    found = fx.fx_rate_rows(orders, snapshot, "p", date(2024, 1, 5))
    assert sorted({row[0] for row in rows(found)}) == [date(2024, 1, n) for n in range(1, 5)]


def test_codes_that_differ_in_case_do_not_double_a_rate(spark):
    rates = b.rates(spark, ("2024-01-01", "eur", "2"), ("2024-01-01", "EUR", "1.5"))
    assert [(r[0], r[1], float(r[2])) for r in rows(conform.fact_fx_rates(rates))] == [(20240101, "EUR", 1.5)]


def test_calendar(spark):
    days = generators.calendar(spark, F.lit(date(2024, 2, 29)), years_back=1, days_ahead=366)
    found = {row["date"]: row for row in days.collect()}
    assert min(found) == date(2023, 2, 28) and max(found) == date(2025, 3, 1)
    assert len(found) == (max(found) - min(found)).days + 1
    leap = found[date(2024, 2, 29)]
    assert tuple(leap) == (20240229, date(2024, 2, 29), 2024, 1, 2, 29, 4, False)
    sunday, year_end = found[date(2024, 3, 3)], found[date(2024, 12, 31)]
    assert (sunday["day_of_week"], sunday["is_weekend"]) == (7, True)
    assert (year_end["date_key"], year_end["quarter"], year_end["day_of_week"]) == (20241231, 4, 2)


def test_minutes(spark):
    found = sorted(rows(generators.minutes(spark)))
    assert found == [(minute, minute // 60, minute % 60) for minute in range(1440)]


def test_other_snapshot_shape(spark, tmp_path):
    path = tmp_path / "rates.json"
    path.write_text('{"base": "eur", "date": "2024-05-01", "rates": {"USD": 1.25, "EUR": 1}}')
    found = read_snapshot(spark, str(path)).first()
    assert (found.base_code, found.conversion_rates) == ("EUR", {"USD": 1.25, "EUR": 1.0})
    path.write_text('{"result": "error", "base": "eur", "rates": {"USD": 1.25}}')
    with pytest.raises(ValueError, match="success"):
        read_snapshot(spark, str(path))
