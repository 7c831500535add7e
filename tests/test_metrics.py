from __future__ import annotations

from datetime import date

from saleswh.plans import fact, metrics, views
from tests import builders as b
from tests.conftest import rows

YEAR = ("2024-01-01", "2024-12-31")


def _plain(found):
    return [tuple(float(v) if hasattr(v, "as_tuple") else v for v in row) for row in found]


def _ordered(df):
    return _plain(rows(df, "as_is"))


def test_views(spark):
    facts = b.facts(
        spark,
        {"currency": "USD"},
        {"currency": "EUR", "fx_rate_to_usd": "1.0"},
        {"currency": "EUR", "fx_rate_to_usd": "1.1", "product_id": 99},
        {"currency": "ABC"},
        {"currency": "usd"},
    )
    goods = b.products(spark, (1, "Cup", "Home"))
    base = views.sales_base(facts)
    flags = {r["order_item_id"]: (r["is_non_iso_currency"], r["is_fx_fallback"]) for r in base.collect()}
    assert flags == {1: (False, False), 2: (False, True), 3: (False, False), 4: (True, True), 5: (True, True)}
    enriched = views.sales_enriched(base, goods)
    assert sorted(r["order_item_id"] for r in enriched.collect()) == [1, 2, 4, 5]
    assert len(enriched.columns) == 16 and enriched.columns[-2:] == ["product_category", "product_name"]
    assert sorted(r["order_item_id"] for r in views.sales_clean(enriched).collect()) == [1, 2]
    valid = views.sales_valid(facts)
    assert sorted(r["order_item_id"] for r in valid.collect()) == [1, 2, 3, 5]


def test_invalid_sales(spark):
    bad = [
        {"quantity": None},
        {"quantity": "-1"},
        {"unit_price_orig": None},
        {"unit_price_orig": "-0.01"},
        {"fx_rate_to_usd": None},
        {"fx_rate_to_usd": "0"},
        {"currency": "XYZ"},
    ]
    assert views.sales_valid(b.facts(spark, *bad)).isEmpty()


def test_zero_and_null_currency_are_valid(spark):
    facts = b.facts(spark, {"quantity": "0", "unit_price_orig": "0"}, {"currency": None})
    assert views.sales_valid(facts).count() == 2
    assert views.clean_sales(facts, b.products(spark, (1, "Cup", "Home"))).count() == 1


def test_registered_views_can_be_made_again(spark):
    facts, goods = b.facts(spark, {}), b.products(spark, (1, "Cup", "Home"))
    for _ in range(2):
        views.register_views(facts, goods)
        assert spark.sql("SELECT product_name FROM sales_clean").first()[0] == "Cup"
    assert spark.table("sales_valid").count() == spark.table("sales_base").count() == 1


def test_window_edges(spark):
    star = b.star(spark, b.facts(spark, *({"date_key": k} for k in (20231231, 20240101, 20241231, 20250101))))
    assert _ordered(metrics.category_performance(star, *YEAR)) == [("Home", 2.0, 20.0)]


def test_top_products_order_filter_and_limit(spark):
    goods = b.products(spark, (1, "Cup", "Home"), (2, "Pen", "Office"), (3, "Cup", "Home"), (4, "Ink", None))
    star = b.star(
        spark,
        b.facts(
            spark,
            {"product_id": 1, "line_amount_usd": "5"},
            {"product_id": 3, "line_amount_usd": "6"},
            {"product_id": 2, "line_amount_usd": "11"},
            {"product_id": 4, "line_amount_usd": "3"},
            {"product_id": 5, "line_amount_usd": "99"},
            {"product_id": 1, "line_amount_usd": "99", "currency": "ABC"},
        ),
        goods,
    )
    everything = [("Home", "Cup", 2.0, 11.0), ("Office", "Pen", 1.0, 11.0), (None, "Ink", 1.0, 3.0)]
    assert _ordered(metrics.top_products(star, *YEAR)) == everything
    assert _ordered(metrics.top_products(star, *YEAR, limit=1)) == everything[:1]
    assert _ordered(metrics.top_products(star, *YEAR, categories=["Office"])) == everything[1:2]
    assert _ordered(metrics.top_products(star, *YEAR, categories=[])) == []
    assert _ordered(metrics.revenue_by_product(star, *YEAR)) == [("Cup", 11.0, 2.0), ("Pen", 11.0, 1.0), ("Ink", 3.0, 1.0)]
    assert _ordered(metrics.top_products_all_currencies(star, limit=1)) == [("Cup", 3.0, 110.0)]
    assert _ordered(metrics.revenue_by_category(star, *YEAR))[-1] == (None, 3.0, 1.0)


def test_hours(spark):
    star = b.star(spark, b.facts(spark, {"time_key": 59}, {"time_key": 60}, {"time_key": 119, "quantity": "2"}))
    assert _ordered(metrics.revenue_by_hour(star, *YEAR)) == [(0, 10.0, 1.0), (1, 20.0, 3.0)]
    assert _ordered(metrics.best_hours(star, *YEAR)) == [(1, 20.0, 3.0), (0, 10.0, 1.0)]


def test_moving_average_is_over_days_with_sales(spark):
    days = [20240101, 20240103, 20240110, 20240201, 20240202, 20240301, 20240401, 20240501, 20240502]
    star = b.star(
        spark, b.facts(spark, *({"date_key": k, "line_amount_usd": n} for n, k in enumerate(reversed(days), 1)))
    )
    amounts = list(range(9, 0, -1))
    expected = [sum(amounts[max(0, i - 6) : i + 1]) / len(amounts[max(0, i - 6) : i + 1]) for i in range(9)]
    found = _ordered(metrics.daily_revenue_ma(star, *YEAR))
    assert [row[2] for row in found] == expected
    assert found[1][:2] == (date(2024, 1, 3), 8.0)
    total = [row[1] for row in _ordered(metrics.daily_revenue_cumulative(star, *YEAR))]
    assert total == [9.0, 17.0, 24.0, 30.0, 35.0, 39.0, 42.0, 44.0, 45.0]


def test_totals_agree(spark):
    """Hours, days, weekdays, the matrix and the running total add up to the same."""
    star = b.star(
        spark,
        b.facts(
            spark,
            *(
                {"date_key": 20240101 + n % 28, "time_key": n * 97 % 1440, "line_amount_usd": f"{n}.{n:04d}"}
                for n in range(60)
            ),
        ),
    )
    daily = sum(r["revenue"] for r in metrics.daily_revenue(star, *YEAR).collect())
    assert sum(r["revenue"] for r in metrics.revenue_by_hour(star, *YEAR).collect()) == daily
    assert sum(r["revenue"] for r in metrics.weekday_hour_revenue(star, *YEAR).collect()) == daily
    assert metrics.daily_revenue_cumulative(star, *YEAR).collect()[-1]["cumulative_revenue"] == daily
    matrix = metrics.weekday_hour_matrix(star, *YEAR).collect()
    assert sum(sum(row[1:]) for row in matrix) == daily
    hourly = fact.hourly_sales(star.fact, star.dim_date, star.dim_time).collect()
    assert sum(r["revenue_usd"] for r in hourly) == daily and sum(r["items_count"] for r in hourly) == 60


def test_weekday_matrix_is_always_seven_by_twenty_four(spark):
    star = b.star(spark, b.facts(spark, {"date_key": 20240103, "time_key": 125}, {"date_key": 20240110, "time_key": 130}))
    matrix = _ordered(metrics.weekday_hour_matrix(star, *YEAR))
    assert [row[0] for row in matrix] == [1, 2, 3, 4, 5, 6, 7] and {len(row) for row in matrix} == {25}
    assert matrix[2][3] == 20.0 and sum(sum(row[1:]) for row in matrix) == 20.0


def test_monthly_matrix_of_the_top_categories(spark):
    goods = b.products(spark, *((n, f"p{n}", f"c{n}") for n in range(1, 8)), (8, "x", None))
    sales = [{"product_id": n, "line_amount_usd": str(n), "date_key": 20240100 + n} for n in range(1, 8)]
    sales += [{"product_id": 7, "date_key": 20240301, "line_amount_usd": "2"}]
    sales += [{"product_id": 1, "date_key": 20240401}, {"product_id": 8, "line_amount_usd": "999"}]
    star = b.star(spark, b.facts(spark, *sales), goods)
    matrix = metrics.monthly_top_matrix(star, *YEAR)
    # c1 has 11 in all, so c2 and c3 are left out.
    assert matrix.columns == ["month", "c1", "c4", "c5", "c6", "c7"]
    assert _ordered(matrix) == [
        (date(2024, 1, 1), 1.0, 4.0, 5.0, 6.0, 7.0),
        (date(2024, 3, 1), 0.0, 0.0, 0.0, 0.0, 2.0),
        (date(2024, 4, 1), 10.0, 0.0, 0.0, 0.0, 0.0),
    ]
    long = metrics.monthly_top_rows(star, *YEAR)
    assert long.count() == 15 and sum(r["revenue"] for r in long.collect()) == 35
    months = metrics.monthly_revenue_by_category(star, *YEAR)
    assert _ordered(months)[-1] == (None, date(2024, 1, 1), 999.0)


def test_customers_and_countries(spark):
    people = b.customers(
        spark, (1, "Ann", "PT"), (2, " ", None), (3, None, ""), (4, "Ann", "PT"), (5, "Bo", "  PT ")
    )
    star = b.star(
        spark,
        b.facts(
            spark,
            {"customer_id": 1, "order_id": 10, "line_amount_usd": "1"},
            {"customer_id": 1, "order_id": 10, "line_amount_usd": "2"},
            {"customer_id": 4, "order_id": 11, "line_amount_usd": "4"},
            {"customer_id": 2, "order_id": 12, "line_amount_usd": "8"},
            {"customer_id": 3, "order_id": 13, "line_amount_usd": "16"},
            {"customer_id": 5, "order_id": 14, "line_amount_usd": "32"},
            {"customer_id": 99, "order_id": 15, "line_amount_usd": "64"},
        ),
        people=people,
    )
    # The stored country decides the group: NULL and blank stay apart, so do 'PT' and '  PT '.
    assert _ordered(metrics.top_customers(star, *YEAR)) == [
        ("Unknown", "Unknown", 2, 72.0),
        ("Bo", "PT", 1, 32.0),
        ("Unknown", "Unknown", 1, 16.0),
        ("Ann", "PT", 2, 7.0),
    ]
    assert _ordered(metrics.revenue_by_country(star, *YEAR)) == [
        ("Unknown", 72.0),
        ("PT", 32.0),
        ("Unknown", 16.0),
        ("PT", 7.0),
    ]
    # The average groups by label again, so here they come together.
    assert _ordered(metrics.avg_order_value_by_country(star, *YEAR)) == [
        ("Unknown", (64 + 8 + 16) / 3),
        ("PT", (3 + 4 + 32) / 3),
    ]
    assert _ordered(metrics.top_customer_labels(star, *YEAR, limit=2)) == [
        ("Unknown Customer — Unknown", 72.0),
        ("Bo — Pt", 32.0),
    ]
    assert len(_ordered(metrics.top_customers(star, *YEAR, limit=3))) == 3


def test_currency_reports(spark):
    star = b.star(
        spark,
        b.facts(
            spark,
            {"currency": "USD"},
            {"currency": "EUR", "fx_rate_to_usd": "1.5"},
            {"currency": "EUR", "fx_rate_to_usd": "1"},
            {"currency": "ABC"},
            {"currency": "XYZ"},
            {"currency": "XYZ", "date_key": 20200101},
        ),
    )
    assert _ordered(metrics.non_iso_currency_counts(star)) == [("XYZ", 2), ("ABC", 1)]
    assert _ordered(metrics.fx_coverage(star, *YEAR)) == [(3, 1, 2)]
    assert _ordered(metrics.fx_summary(star)) == [("ABC", 1, 1.0), ("EUR", 2, 1.25), ("USD", 1, 1.0), ("XYZ", 2, 1.0)]
    assert [row[0] for row in _ordered(metrics.fact_spot_check(star, limit=2))] == [1, 2]
    found = _ordered(metrics.fx_reconciliation(star))
    assert [(row[0], row[5]) for row in found] == [(2, 15.0), (3, 10.0)]


def test_latest_rates(spark):
    fx = b.rates(spark, ("2024-01-01", "EUR", "1"), ("2024-01-02", "GBP", "2"), ("2024-01-02", "EUR", "3"))
    found = metrics.fx_latest(b.star(spark, b.facts(spark, {}), fx=fx), limit=2)
    assert [(row["fx_date"].day, row["currency"]) for row in found.collect()] == [(2, "EUR"), (2, "GBP")]


def test_empty_window(spark):
    star = b.star(spark, b.facts(spark, {}))
    none = ("2030-01-01", "2030-12-31")
    for metric in (
        metrics.top_products,
        metrics.category_performance,
        metrics.revenue_by_hour,
        metrics.daily_revenue_ma,
        metrics.daily_revenue_cumulative,
        metrics.top_customers,
        metrics.revenue_by_country,
        metrics.avg_order_value_by_country,
        metrics.monthly_top_matrix,
    ):
        assert metric(star, *none).isEmpty()
    assert _ordered(metrics.fx_coverage(star, *none)) == [(0, 0, 0)]
    assert len(_ordered(metrics.weekday_hour_matrix(star, *none))) == 7


def test_results_do_not_depend_on_row_order(spark):
    sales = [{"product_id": 1 + n % 2, "customer_id": n % 3, "line_amount_usd": "1"} for n in range(12)]
    numbered = [{**sale, "order_item_id": n, "order_id": n} for n, sale in enumerate(sales)]
    results = []
    for order in (numbered, numbered[::-1]):
        star = b.star(spark, b.facts(spark, *order).repartition(3))
        results.append([_ordered(m(star, *YEAR)) for m in (metrics.top_products, metrics.top_customers)])
    assert results[0] == results[1]
