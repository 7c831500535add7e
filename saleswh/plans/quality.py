"""Data-quality checks on the fact, and the constraints every load must meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswh.functions.money import is_iso

NON_ISO_MAX_SHARE = 0.50


class QualityError(ValueError):
    pass


def dq_checks(
    fact: DataFrame,
    dim_date: DataFrame,
    dim_time: DataFrame,
    clean: DataFrame,
    non_iso_max_share: float = NON_ISO_MAX_SHARE,
) -> DataFrame:
    """One row per check: name, level (info, ok, warning, issue), failed rows, message.

    All row rules and both key checks come from one pass: the fact is counted
    per day and minute, and only those counts meet the two dimensions.
    """
    fx, quantity, price = F.col("fx_rate_to_usd"), F.col("quantity"), F.col("unit_price_orig")
    per_minute = fact.groupBy("date_key", "time_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~is_iso(F.col("currency"))).alias("non_iso"),
        F.count_if(fx.isNull() | (fx <= 0)).alias("bad_fx"),
        F.count_if(quantity.isNull() | (quantity < 0)).alias("bad_quantity"),
        F.count_if(price.isNull() | (price < 0)).alias("bad_price"),
    )
    totals = _with_key_marks(per_minute, dim_date, dim_time).agg(
        _total("n").alias("rows"),
        _total("n", F.col("has_date").isNull()).alias("bad_date"),
        _total("n", F.col("has_time").isNull()).alias("bad_time"),
        *(_total(name).alias(name) for name in ("non_iso", "bad_fx", "bad_quantity", "bad_price")),
    )
    share = F.when(F.col("rows") == 0, F.lit(0.0)).otherwise(F.col("non_iso") / F.col("rows"))
    non_iso_level = (
        F.when(share > non_iso_max_share, "issue").when(F.col("non_iso") > 0, "warning").otherwise("ok")
    )
    checks = [
        _check("fact_rows", F.lit("info"), F.col("rows")),
        _check("missing_date_keys", _issue_if_any("bad_date"), F.col("bad_date")),
        _check("missing_time_keys", _issue_if_any("bad_time"), F.col("bad_time")),
        _check("non_iso_currency", non_iso_level, F.col("non_iso")),
        _check("invalid_fx_rate", _issue_if_any("bad_fx"), F.col("bad_fx")),
        _check("invalid_quantity", _issue_if_any("bad_quantity"), F.col("bad_quantity")),
        _check("invalid_unit_price", _issue_if_any("bad_price"), F.col("bad_price")),
    ]
    # Tenths of a percent, rounded half up in whole numbers.
    tenths = F.expr("(2000 * non_iso + rows) DIV (2 * greatest(rows, 1))")
    shown = F.when((F.col("check_name") == "non_iso_currency") & (F.col("non_iso") > 0), tenths).alias("tenths")
    one_pass = totals.select("rows", "non_iso", F.inline(F.array(*checks))).select(
        "check_name", "level", "failed_rows", shown
    )
    repeated = duplicate_items(fact).agg(F.count(F.lit(1)).alias("failed"))
    # As a filter the flag meets the view's own and folds away, unless the view leaks.
    leaked = clean.filter("is_non_iso_currency").agg(F.count(F.lit(1)).alias("failed"))
    rest = [
        repeated.select(F.inline(F.array(_check("duplicate_items", _issue_if_any("failed"), F.col("failed"))))),
        leaked.select(F.inline(F.array(_check("non_iso_in_clean", _issue_if_any("failed"), F.col("failed"))))),
    ]
    none = F.lit(None).cast("bigint")
    result = one_pass.unionByName(rest[0].withColumn("tenths", none)).unionByName(rest[1].withColumn("tenths", none))
    above = F.when(F.col("level") == "issue", F.lit(f" > {non_iso_max_share:.0%} threshold")).otherwise("")
    share = F.concat(F.expr("format_string(' (%d.%d%%)', tenths DIV 10, tenths % 10)"), above)
    return result.select(
        "check_name",
        "level",
        "failed_rows",
        F.concat(
            F.concat_ws(": ", "check_name", F.col("failed_rows").cast("string")),
            F.when(F.col("tenths").isNotNull(), share).otherwise(""),
        ).alias("message"),
    )


def verdict_rows(checks: DataFrame) -> DataFrame:
    """The verdict as one row: ``passed``, and the messages of issues and warnings in order."""

    def messages(level: str) -> Column:
        return F.array_join(F.array_sort(F.collect_list(F.when(F.col("level") == level, F.col("message")))), "; ")

    return checks.agg(
        (F.count_if(F.col("level") == "issue") == 0).alias("passed"),
        messages("issue").alias("issues"),
        messages("warning").alias("warnings"),
    )


def duplicate_items(fact: DataFrame) -> DataFrame:
    """Order items stored more than once, with their number of rows."""
    counts = fact.groupBy("order_item_id").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.filter("row_count > 1")


def verdict(checks: DataFrame) -> list[str]:
    """Returns the warnings of a check result, or raises on any issue."""
    found = checks.filter(F.col("level").isin("warning", "issue")).collect()
    issues = sorted(row["message"] for row in found if row["level"] == "issue")
    if issues:
        raise QualityError("data-quality checks failed: " + "; ".join(issues))
    return sorted(row["message"] for row in found)


MANDATORY = [
    "order_item_id",
    "order_id",
    "product_id",
    "customer_id",
    "date_key",
    "time_key",
    "quantity",
    "unit_price_orig",
    "currency",
    "fx_rate_to_usd",
]


def _constraints() -> dict[str, Column]:
    """What no stored fact may be; the last two need the marks of known days and minutes."""
    rules = {f"{name} is missing": F.col(name).isNull() for name in MANDATORY}
    rules["currency has more than three characters"] = F.coalesce(F.length(F.rtrim("currency")) > 3, F.lit(False))
    rules["date_key is not in the calendar"] = F.col("has_date").isNull()
    rules["time_key is not in the day"] = F.col("has_time").isNull()
    return rules


def with_broken(rows: DataFrame, dim_date: DataFrame, dim_time: DataFrame) -> DataFrame:
    """``rows`` with ``broken``, the constraints that a row breaks by name; an empty array for a sound one.

    Amounts that do not fit their columns have raised before, in their casts.
    """
    marked = _with_key_marks(rows, dim_date, dim_time)
    named = F.array(*(F.when(rule, F.lit(name)) for name, rule in _constraints().items()))
    return marked.select(*rows.columns, F.array_compact(named).alias("broken"))


def broken_counts() -> list[Column]:
    """Rows per constraint, as aggregates over ``broken``; small enough to observe while rows are written."""
    return [F.count_if(F.array_contains("broken", name)).alias(name) for name in _constraints()]


def refusals(checked: DataFrame) -> DataFrame:
    """Rows with ``broken`` counted per constraint: ``rule``, ``rows``; no row for a constraint that holds."""
    return checked.select(F.explode("broken").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("rows"))


def refuse(counts: dict[str, int]) -> None:
    """Raises if any constraint is broken: a load is refused as a whole."""
    broken = [f"{name} ({counts[name]} rows)" for name in _constraints() if counts.get(name)]
    if broken:
        raise QualityError("fact load refused: " + "; ".join(broken))


def assert_loadable(rows: DataFrame, dim_date: DataFrame, dim_time: DataFrame) -> None:
    """The same for rows that are not being written anyway."""
    refuse(with_broken(rows, dim_date, dim_time).agg(*broken_counts()).first().asDict())


def _with_key_marks(rows: DataFrame, dim_date: DataFrame, dim_time: DataFrame) -> DataFrame:
    dates = dim_date.select("date_key", F.lit(True).alias("has_date"))
    times = dim_time.select("time_key", F.lit(True).alias("has_time"))
    return rows.join(dates, "date_key", "left").join(times, "time_key", "left")


def _total(count: str, only: Column | None = None) -> Column:
    counted = F.col(f"`{count}`")
    return F.coalesce(F.sum(counted if only is None else F.when(only, counted)), F.lit(0))


def _issue_if_any(count: str) -> Column:
    return F.when(F.col(count) > 0, "issue").otherwise("ok")


def _check(name: str, level: Column, failed: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"), level.alias("level"), failed.alias("failed_rows")
    )
