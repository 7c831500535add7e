from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from saleswh.plans import quality, views
from saleswh.sources import generators
from tests import builders as b


def _checks(spark, facts, clean=None, **options):
    goods = b.products(spark, (1, "Cup", "Home"))
    days = generators.calendar(spark, F.lit(date(2024, 6, 1)))
    found = quality.dq_checks(
        facts, days, generators.minutes(spark), clean or views.clean_sales(facts, goods), **options
    )
    return {row["check_name"]: (row["level"], row["failed_rows"]) for row in found.collect()}


def test_clean_facts_pass(spark):
    found = _checks(spark, b.facts(spark, {}, {"currency": "EUR"}))
    assert found.pop("fact_rows") == ("info", 2)
    assert len(found) == 8 and set(found.values()) == {("ok", 0)}


def test_each_check_counts_its_bad_rows(spark):
    bad = [
        {"order_item_id": 1},
        {"order_item_id": 1},
        {"date_key": 19900101},
        {"date_key": None},
        {"time_key": 1440},
        {"fx_rate_to_usd": "0"},
        {"fx_rate_to_usd": "-1"},
        {"fx_rate_to_usd": None},
        {"quantity": "-1"},
        {"quantity": None},
        {"quantity": "0"},
        {"unit_price_orig": "-0.01"},
        {"unit_price_orig": None},
        {"unit_price_orig": "0"},
    ]
    assert _checks(spark, b.facts(spark, {}, *bad)) == {
        "fact_rows": ("info", 15),
        "duplicate_items": ("issue", 1),
        "missing_date_keys": ("issue", 2),
        "missing_time_keys": ("issue", 1),
        "non_iso_currency": ("ok", 0),
        "invalid_fx_rate": ("issue", 3),
        "invalid_quantity": ("issue", 2),
        "invalid_unit_price": ("issue", 2),
        "non_iso_in_clean": ("ok", 0),
    }


def test_non_iso_share(spark):
    half = b.facts(spark, {}, {"currency": "ABC"})
    most = b.facts(spark, {}, {"currency": "ABC"}, {"currency": "XYZ"})
    assert _checks(spark, half)["non_iso_currency"] == ("warning", 1)
    assert _checks(spark, most)["non_iso_currency"] == ("issue", 2)
    assert _checks(spark, most, non_iso_max_share=0.9)["non_iso_currency"] == ("warning", 2)


def test_non_iso_in_the_clean_view(spark):
    facts = b.facts(spark, {}, {"currency": "ABC"})
    found = _checks(spark, facts, clean=views.sales_base(facts))
    assert found["non_iso_in_clean"] == ("issue", 1)


def test_empty_fact(spark):
    found = _checks(spark, b.facts(spark, {}).filter("false"))
    assert found.pop("fact_rows") == ("info", 0)
    assert set(found.values()) == {("ok", 0)}


def test_verdict(spark):
    def result(*levels):
        named = [(f"c{n}", level, n, f"c{n}: {n}") for n, level in enumerate(levels)]
        return spark.createDataFrame(named, "check_name string, level string, failed_rows long, message string")

    assert quality.verdict(result("info", "ok", "warning")) == ["c2: 2"]
    with pytest.raises(quality.QualityError, match="c1: 1; c2: 2"):
        quality.verdict(result("warning", "issue", "issue"))


def test_a_bad_row_refuses_the_whole_load(spark):
    days = generators.calendar(spark, F.lit(date(2024, 6, 1)))
    with pytest.raises(quality.QualityError, match=r"refused: time_key is not in the day \(1 rows\)$"):
        quality.assert_loadable(b.facts(spark, {}, {"time_key": 1440}), days, generators.minutes(spark))


def test_every_broken_constraint_is_named(spark):
    missing = ["order_id", "product_id", "customer_id", "date_key", "time_key", "quantity", "currency"]
    bad = [{name: None} for name in missing]
    bad += [
        {"date_key": 19900101},
        {"currency": "EURO"},
        {"quantity": "100000000"},
        {"unit_price_orig": "-100000000"},
        {"fx_rate_to_usd": "10000"},
    ]
    days = generators.calendar(spark, F.lit(date(2024, 6, 1)))
    with pytest.raises(quality.QualityError) as error:
        quality.assert_loadable(b.facts(spark, {}, *bad), days, generators.minutes(spark))
    reasons = [f"{name} is missing (1 rows)" for name in missing]
    reasons += [
        "date_key is not in the calendar (2 rows)",
        "currency has more than three characters (1 rows)",
    ]
    assert [reason for reason in reasons if reason not in str(error.value)] == []


def test_good_rows_load(spark):
    days = generators.calendar(spark, F.lit(date(2024, 6, 1)))
    quality.assert_loadable(b.facts(spark, {}, {"currency": "ABC"}), days, generators.minutes(spark))
