from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleswh.functions import keys, labels, money
from tests.conftest import rows


def test_date_and_time_keys(spark):
    df = spark.sql(
        "SELECT explode(array(TIMESTAMP_NTZ '2024-08-09 14:35:00', TIMESTAMP_NTZ '2024-08-09 00:01:00', "
        "TIMESTAMP_NTZ '2024-12-31 23:59:59.999')) AS ts"
    )
    found = rows(df.select(keys.date_key(F.col("ts")), keys.time_key(F.col("ts"))), "as_is")
    assert found == [(20240809, 875), (20240809, 1), (20241231, 1439)]


def test_keys_lead_back_to_dates_and_hours(spark):
    df = spark.sql("SELECT 20240229 AS date_key, CAST(1439 AS SMALLINT) AS time_key")
    day = keys.key_to_date()
    found = df.select(day, keys.hour_of_day(), keys.weekday_iso(day), keys.month_start(day), keys.month_of_key())
    assert rows(found) == [(date(2024, 2, 29), 23, 4, date(2024, 2, 1), 202402)]


def test_weekday_of_sunday_is_seven(spark):
    assert rows(spark.range(1).select(keys.weekday_iso(F.lit(date(2024, 3, 3))))) == [(7,)]


def test_window_includes_both_ends(spark):
    df = spark.createDataFrame([(20231231,), (20240101,), (20240131,), (20240201,)], "date_key int")
    assert rows(keys.in_window(df, "2024-01-01", "2024-01-31")) == [(20240101,), (20240131,)]
    assert keys.as_key(date(2024, 1, 5)) == 20240105


def test_currency_is_normalised_but_not_trimmed(spark):
    df = spark.createDataFrame([(None,), ("usd",), ("EUR",), (" abc",)], "c string")
    found = {row[0] for row in df.select(money.normal_currency(F.col("c"))).collect()}
    assert found == {"USD", "EUR", " ABC"}


def test_currency_flags(spark):
    df = spark.createDataFrame(
        [("USD", 1.0), ("EUR", 1.0), ("ABC", 1.0), ("EUR", 1.1)], "c string, fx double"
    ).select("c", F.col("fx").cast("decimal(18,8)").alias("fx"))
    found = rows(df.select(~money.is_iso(F.col("c")), money.is_fx_fallback(F.col("c"), F.col("fx"))), "as_is")
    assert found == [(False, False), (False, True), (True, True), (False, False)]


def _amount(spark, quantity, price, rate):
    df = spark.createDataFrame([(quantity, price, rate)], "q string, p string, r string").selectExpr(
        "CAST(q AS DECIMAL(18,4)) AS q", "CAST(p AS DECIMAL(18,4)) AS p", "CAST(r AS DECIMAL(18,8)) AS r"
    )
    return df.select(
        money.unit_price_usd(F.col("p"), F.col("r")),
        money.line_amount_usd(F.col("q"), F.col("p"), F.col("r")),
    ).first()


def test_amount_is_rounded_once(spark):
    # Rounding to six places first would make this 0.0001.
    assert _amount(spark, "1", "0.1", "0.00049996")[1] == Decimal("0.0000")
    assert _amount(spark, "1", "0.1", "0.00050000")[1] == Decimal("0.0001")


def test_large_amounts_and_rates_are_exact(spark):
    found = _amount(spark, "99999.9999", "99999.9999", "999.99999999")
    assert found == (Decimal("99999999.8990"), Decimal("9999999979900.0000"))
    found = _amount(spark, "3", "150000000.1234", "20000")
    assert found == (Decimal("3000000002468.0000"), Decimal("9000000007404.0000"))
    assert _amount(spark, "7", "99999999999.9999", "1.16198")[1] == Decimal("813385999999.9992")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        _amount(spark, "1", "99999999999999", "2")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.integers(0, 10**8),
            st.integers(0, 10**9),
            st.integers(1, 10**10),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_amounts_equal_exact_arithmetic(spark, cases):
    from decimal import ROUND_HALF_UP

    triples = [(Decimal(q) / 10**4, Decimal(p) / 10**4, Decimal(r) / 10**8) for q, p, r in cases]
    df = spark.createDataFrame(triples, "q decimal(18,4), p decimal(18,4), r decimal(18,8)")
    found = [row[0] for row in df.select(money.line_amount_usd(F.col("q"), F.col("p"), F.col("r"))).collect()]
    assert found == [(q * p * r).quantize(Decimal("0.0001"), ROUND_HALF_UP) for q, p, r in triples]


@pytest.mark.parametrize(
    ("code", "units", "base", "usd_units", "expected"),
    [
        ("USD", None, "USD", None, "1.00000000"),
        ("EUR", 0.8, "USD", 1.0, "1.25000000"),
        ("EUR", None, "USD", 1.0, "1.00000000"),
        ("EUR", 0.0, "USD", 1.0, "1.00000000"),
        ("GBP", 0.5, "EUR", 1.25, "2.50000000"),
        ("EUR", 1.0, "EUR", 1.25, "1.25000000"),
        ("USD", 1.25, "EUR", 1.25, "1.00000000"),
        ("GBP", 0.5, "EUR", None, "1.00000000"),
        ("GBP", 0.5, "EUR", 0.0, "1.00000000"),
        ("GBP", 0.0, "EUR", 1.25, "1.00000000"),
        ("GBP", 3.0, "USD", None, "0.33333333"),
    ],
)
def test_usd_rate(spark, code, units, base, usd_units, expected):
    df = spark.createDataFrame([(code, units, base, usd_units)], "c string, u double, b string, d double")
    found = df.select(money.usd_rate(F.col("c"), F.col("u"), F.col("b"), F.col("d"))).first()[0]
    assert found == Decimal(expected)


def test_unknown_labels(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), (" Rui ",)], "x string")
    assert [row[0] for row in df.select(labels.or_unknown(F.col("x"))).collect()] == ["Unknown"] * 3 + ["Rui"]


@pytest.mark.parametrize(
    ("name", "country", "expected"),
    [
        (None, None, "Unknown Customer — Unknown"),
        ("~unknown x", "south korea", "Unknown Customer — South Korea"),
        (" \t UNKNOWN\t", " usa\n", "Unknown Customer — Usa"),
        ("Ann Lee", "o'neil-land", "Ann Lee — O'Neil-Land"),
        ("The unknown", "NATION_7b", "The unknown — Nation_7B"),
        ("", "ålesund", " — Ålesund"),
    ],
)
def test_customer_label(spark, name, country, expected):
    df = spark.createDataFrame([(name, country)], "n string, c string")
    assert df.select(labels.customer_label(F.col("n"), F.col("c"))).first()[0] == expected


def test_title_case_agrees_with_python(spark):
    words = ["o'neil", "SOUTH korea", "a1b2", "x_y-z", "été", ""]
    df = spark.createDataFrame([(word,) for word in words], "x string")
    assert [row[0] for row in df.select(labels.title_case(F.col("x"))).collect()] == [w.title() for w in words]


def test_outer_blanks_of_any_kind_are_removed(spark):
    df = spark.createDataFrame([("\u00a0~ unknown 7\u2003", "\u00a0south korea\u3000")], "n string, c string")
    assert df.select(labels.customer_label(F.col("n"), F.col("c"))).first()[0] == "Unknown Customer — South Korea"
