from __future__ import annotations

from datetime import date, datetime

import pytest

from saleswh.operators import files
from saleswh.plans import export, metrics
from saleswh.plans.pipeline import Warehouse
from saleswh.plans.quality import QualityError
from tests import builders as b

AS_OF = date(2024, 6, 1)
YEAR = ("2024-01-01", "2024-12-31")

ORDERS = [
    (1, 1, "2024-01-05 09:30:00", "EUR"),
    (2, 2, "2024-01-06 10:00:00", None),
    (3, 1, "2024-02-06 10:15:00", "ABC"),
]
ITEMS = [(1, 1, 1, 2, "10.00"), (2, 2, 2, 1, "4.50"), (3, 3, 1, 1, "7.00"), (4, 1, 77, 1, "1.00")]
PRODUCTS = [(1, "Cup", "Home"), (2, "Pen", "Office")]
CUSTOMERS = [(1, "Ann", "a@x", "PT"), (2, None, None, None)]


def _sources(spark, orders=ORDERS, items=ITEMS):
    from decimal import Decimal

    exact = [(*row[:4], Decimal(row[4])) for row in items]
    return b.sources(spark, orders, exact, PRODUCTS, CUSTOMERS)


def test_full_run_and_second_run(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    first = warehouse.run(_sources(spark), AS_OF, loaded_at=datetime(2024, 6, 1))
    assert first == ["hourly sales refreshed", "non_iso_currency: 1 (25.0%)"]
    before = {row["order_item_id"]: row for row in warehouse.fact.read().collect()}
    assert {n: float(row["line_amount_usd"]) for n, row in before.items()} == {1: 25.0, 2: 4.5, 3: 7.0, 4: 1.25}
    assert spark.table("sales_clean").count() == 2

    warehouse.run(_sources(spark), AS_OF, loaded_at=datetime(2024, 6, 2))
    after = {row["order_item_id"]: row for row in warehouse.fact.read().collect()}
    assert after == before
    assert warehouse.dim_date.read().count() == (date(2025, 6, 1) - date(2019, 6, 1)).days + 1
    hourly = {(row["date"].month, row["hour"]): float(row["revenue_usd"]) for row in warehouse.hourly_sales.read().collect()}
    assert hourly == {(1, 9): 26.25, (1, 10): 4.5, (2, 10): 7.0}


def test_single_date_rates_leave_older_sales_on_the_fallback(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.run(_sources(spark), AS_OF, run_date=date(2024, 1, 6))
    assert {row["fx_date"] for row in warehouse.dim_fx_rate.read().collect()} == {date(2024, 1, 6)}
    assert {str(row["fx_rate_to_usd"]) for row in warehouse.fact.read().collect()} == {"1.00000000"}
    assert metrics.fx_coverage(warehouse.star(), *YEAR).collect()[0][:2] == (2, 1)


def test_no_orders(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    sources = _sources(spark)
    empty = type(sources)(**{**vars(sources), "orders": sources.orders.filter("false")})
    assert warehouse.run(empty, AS_OF) == ["hourly sales refreshed"]
    assert warehouse.dim_fx_rate.read().isEmpty() and warehouse.fact.read().isEmpty()


def test_refused_load_changes_nothing(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.run(_sources(spark), AS_OF)
    before = warehouse.fact.folders()
    late = [*ORDERS, (4, 1, "1999-01-01 00:00:00", "USD")]
    with pytest.raises(QualityError, match="not in the calendar"):
        warehouse.load_fact(_sources(spark, late, [*ITEMS, (5, 4, 1, 1, "1.00")]), datetime(2024, 6, 3))
    assert warehouse.fact.folders() == before


def test_failing_refresh_is_reported(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.run(_sources(spark), AS_OF)
    (tmp_path / "hourly_sales" / "version=2").write_text("in the way")
    message = warehouse.refresh_hourly_sales()
    assert message.startswith("hourly sales") and warehouse.hourly_sales.read().count() == 3


def test_export(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    warehouse.run(_sources(spark), AS_OF)
    out = tmp_path / "csv"
    star = warehouse.star()
    names = [report.name for report in export.reports(star, *YEAR)]
    assert len(names) == 9
    assert export.export_reports(star, str(out), *YEAR) == names
    assert _lines(out, "revenue_by_category") == ["product_category,revenue,units", "Home,25.0000,2.0000", "Office,4.5000,1.0000"]
    assert _lines(out, "mom_by_category_top5_bars") == ["month,Home,Office", "2024-01-01,25.0000,4.5000"]

    empty = ("2030-01-01", "2030-12-31")
    skipped = {"daily_revenue_with_ma", "daily_revenue_cumulative", "mom_by_category_top5_bars"}
    assert set(export.export_reports(star, str(out), *empty)) == set(names) - skipped
    assert not any((out / name).exists() for name in skipped)
    assert _lines(out, "top_customers") == ["customer_name,country,orders,revenue"]


def test_export_with_a_large_catalogue_joins_it_once(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    warehouse.run(_sources(spark), AS_OF)
    star = warehouse.star()
    names = export.export_reports(star, str(tmp_path / "small"), *YEAR)
    written, given = [], []
    real, plain = metrics.write_once, export.reports
    monkeypatch.setattr(metrics, "write_once", lambda df, name: written.append(real(df, name)) or written[-1])
    monkeypatch.setattr(export, "reports", lambda shared, *window: given.append(shared) or plain(shared, *window))
    # Spark's estimate of the two products is far below, their rows are not.
    monkeypatch.setattr("saleswh.operators.joins.ROW_BYTES", 10 << 20)
    assert export.export_reports(star, str(tmp_path / "large"), *YEAR) == names
    for name in names:
        assert _lines(tmp_path / "large", name) == _lines(tmp_path / "small", name)
    ((joined, path),) = written
    assert given == [given[0]] and given[0].fact is joined and not files.exists(spark, path)


def _lines(out, name):
    parts = sorted((out / name).glob("part-*.csv"))
    return list(dict.fromkeys(line for part in parts for line in part.read_text().splitlines()))
