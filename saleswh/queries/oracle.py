"""Independent SQL for the named queries, straight from the given tables.

Nothing here is shared with the Spark side but the parameters: each statement
works the facts out anew from the raw tables.
"""

from __future__ import annotations

from saleswh.queries.registry import (
    EVENTS_AS_OF,
    FILTERED_CATEGORIES,
    FX_RUN_DATE,
    MOVED_DAYS,
    RETAIL_AS_OF,
)
from saleswh.sources import retail

RETAIL_START, RETAIL_END = retail.RETAIL_WINDOW
EVENTS_START, EVENTS_END = retail.EVENTS_WINDOW

RETAIL_ORDERS = """orders_src AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS ts, o_orderstatus AS status,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'USD' WHEN '2-HIGH' THEN 'EUR'
              WHEN '3-MEDIUM' THEN 'GBP' WHEN '4-NOT SPECIFIED' THEN 'ABC' END AS currency
  FROM orders)"""

RETAIL_ITEMS = """items_src AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
         CAST(l_quantity AS DECIMAL(18,4)) AS quantity, CAST(l_extendedprice AS DECIMAL(18,4)) AS price
  FROM lineitem)"""

RETAIL_DIMS = """products_src AS (SELECT p_partkey AS product_id, p_name AS name, p_brand AS category FROM part),
customers_src AS (SELECT c_custkey AS customer_id, CAST(NULL AS VARCHAR) AS full_name, n_name AS country
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

EVENT_ORDERS = """orders_src AS (
  SELECT event_id AS order_id, user_id AS customer_id, ts, '' AS status,
         CASE user_id % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'eur' WHEN 2 THEN 'GBP' WHEN 3 THEN 'ABC' END AS currency
  FROM events)"""

EVENT_ITEMS = """items_src AS (
  SELECT event_id AS order_item_id, event_id AS order_id,
         CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3
              WHEN 'purchase' THEN 4 WHEN 'error' THEN 5 ELSE 0 END AS product_id,
         CAST(1 AS DECIMAL(18,4)) AS quantity, CAST(value AS DECIMAL(18,4)) AS price
  FROM events)"""

EVENT_DIMS = """products_src AS (SELECT DISTINCT CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2
    WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4 ELSE 0 END AS product_id, event_type AS name, event_type AS category
  FROM events WHERE event_type <> 'error'),
customers_src AS (SELECT c_custkey AS customer_id, c_name AS full_name, n_name AS country
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

CURRENCIES = """currencies AS (
  SELECT DISTINCT substring(upper(currency), 1, 3) AS currency FROM orders_src WHERE currency IS NOT NULL
  UNION SELECT 'USD' UNION SELECT 'EUR' UNION SELECT 'GBP')"""

# Rates of a USD-based and of a EUR-based snapshot.
USD_BASED = f"""CASE currency WHEN 'USD' THEN 1.0
    WHEN 'EUR' THEN CAST(1 AS DOUBLE) / CAST({retail.USD_QUOTES['EUR']} AS DOUBLE)
    WHEN 'GBP' THEN CAST(1 AS DOUBLE) / CAST({retail.USD_QUOTES['GBP']} AS DOUBLE) ELSE 1.0 END"""
EUR_BASED = f"""CASE currency WHEN 'USD' THEN 1.0
    WHEN 'EUR' THEN CAST({retail.EUR_QUOTES['USD']} AS DOUBLE) / CAST(1 AS DOUBLE)
    WHEN 'GBP' THEN CAST({retail.EUR_QUOTES['USD']} AS DOUBLE) / CAST({retail.EUR_QUOTES['GBP']} AS DOUBLE)
    ELSE 1.0 END"""


ORDER_DAYS = """SELECT CAST(unnest(generate_series(CAST(CAST(min(ts) AS DATE) AS TIMESTAMP),
           CAST(CAST(max(ts) AS DATE) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS fx_date
  FROM orders_src"""


def _fx(days: str) -> str:
    return f"""{CURRENCIES},
fx_days AS ({days}),
fx AS (SELECT fx_date, currency, CAST({USD_BASED} AS DECIMAL(18,8)) AS rate FROM fx_days CROSS JOIN currencies)"""


RETAIL_FX = _fx(ORDER_DAYS)
EVENT_FX = _fx(f"SELECT DATE '{retail.EVENTS_RUN_DATE}' AS fx_date")


def _facts(name: str, orders: str = "orders_src", fx: str = "fx", keep_copies: bool = False) -> str:
    first_only = "" if keep_copies else "WHERE copy = 1"
    return f"""{name}_sales AS (
  SELECT i.order_item_id, i.order_id, i.product_id, o.customer_id,
         CAST(strftime(o.ts, '%Y%m%d') AS INTEGER) AS date_key, CAST(o.ts AS DATE) AS fx_date,
         CAST(hour(o.ts) * 60 + minute(o.ts) AS SMALLINT) AS time_key,
         i.quantity, i.price, upper(coalesce(o.currency, 'USD')) AS currency
  FROM items_src i JOIN {orders} o ON o.order_id = i.order_id),
{name}_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY order_item_id
    ORDER BY order_id, product_id, customer_id, date_key, time_key, quantity, price, currency) AS copy
  FROM {name}_sales),
{name} AS (
  SELECT order_item_id, order_id, product_id, customer_id, date_key, time_key, quantity,
         price AS unit_price_orig, r.currency, coalesce(f.rate, CAST(1 AS DECIMAL(18,8))) AS fx_rate_to_usd,
         CAST(CAST(price AS DECIMAL(20,4)) * CAST(coalesce(f.rate, 1) AS DECIMAL(12,8)) AS DECIMAL(18,4))
           AS unit_price_usd,
         CAST(CAST(quantity AS DECIMAL(20,4)) * CAST(price AS DECIMAL(12,4))
              * CAST(coalesce(f.rate, 1) AS DECIMAL(12,8)) AS DECIMAL(18,4)) AS line_amount_usd
  FROM {name}_ranked r LEFT JOIN fx f ON f.fx_date = r.fx_date AND f.currency = r.currency
  {first_only})""".replace("LEFT JOIN fx f", f"LEFT JOIN {fx} f")


VIEWS = """base AS (
  SELECT *, currency NOT IN ('USD', 'EUR', 'GBP') AS is_non_iso_currency,
         fx_rate_to_usd = 1 AND currency <> 'USD' AS is_fx_fallback
  FROM fact),
enriched AS (
  SELECT b.*, p.category AS product_category, p.name AS product_name
  FROM base b JOIN products_src p ON p.product_id = b.product_id),
clean AS (SELECT * FROM enriched WHERE is_non_iso_currency = FALSE),
dated AS (SELECT *, strptime(CAST(date_key AS VARCHAR), '%Y%m%d')::DATE AS d FROM clean)"""

RETAIL = ",\n".join(
    [RETAIL_ORDERS, RETAIL_ITEMS, RETAIL_DIMS, RETAIL_FX, _facts("fact"), VIEWS]
) + f""",
win AS (SELECT * FROM dated WHERE d BETWEEN DATE '{RETAIL_START}' AND DATE '{RETAIL_END}')"""
EVENTS = ",\n".join(
    [EVENT_ORDERS, EVENT_ITEMS, EVENT_DIMS, EVENT_FX, _facts("fact"), VIEWS]
) + f""",
win AS (SELECT * FROM dated WHERE d BETWEEN DATE '{EVENTS_START}' AND DATE '{EVENTS_END}')"""

REVENUE = "CAST(SUM(line_amount_usd) AS DOUBLE) AS revenue"
UNITS = "CAST(SUM(quantity) AS DOUBLE) AS units"
FACT_COLUMNS = """order_item_id, order_id, CAST(product_id AS BIGINT) AS product_id, customer_id, date_key, time_key,
  CAST(quantity AS DOUBLE) AS quantity, CAST(unit_price_orig AS DOUBLE) AS unit_price_orig, currency,
  CAST(fx_rate_to_usd AS DOUBLE) AS fx_rate_to_usd, CAST(unit_price_usd AS DOUBLE) AS unit_price_usd,
  CAST(line_amount_usd AS DOUBLE) AS line_amount_usd"""


def _label(column: str) -> str:
    return f"coalesce(nullif(trim({column}), ''), 'Unknown')"


def _retail(select: str) -> str:
    return f"WITH {RETAIL}\n{select}"


def _events(select: str) -> str:
    return f"WITH {EVENTS}\n{select}"


def _top_products(where: str = "") -> str:
    return _retail(
        f"SELECT product_category, product_name, {UNITS}, {REVENUE} FROM win {where} "
        "GROUP BY product_category, product_name "
        "ORDER BY SUM(line_amount_usd) DESC, product_category, product_name LIMIT 20"
    )


_LISTED = ", ".join(f"'{name}'" for name in FILTERED_CATEGORIES)
_CATEGORY_PERFORMANCE = _retail(
    f"SELECT product_category, {UNITS}, {REVENUE} FROM win GROUP BY product_category"
)
_BY_HOUR = _events(
    f"SELECT CAST(floor(time_key / 60.0) AS INTEGER) AS hour_of_day, {REVENUE}, {UNITS} FROM win GROUP BY 1"
)
_DAILY = "daily AS (SELECT d AS sales_date, SUM(line_amount_usd) AS revenue FROM win GROUP BY d)"
_WEEKDAY_HOURS = (
    "wh AS (SELECT CAST(isodow(d) AS INTEGER) AS weekday_iso, CAST(floor(time_key / 60.0) AS INTEGER) AS hour_of_day,"
    " SUM(line_amount_usd) AS revenue FROM win GROUP BY 1, 2)"
)
_MONTHLY = (
    "monthly AS (SELECT product_category, CAST(date_trunc('month', d) AS DATE) AS month,"
    " SUM(line_amount_usd) AS revenue FROM win GROUP BY 1, 2)"
)
_RECONCILED = """SELECT order_item_id, currency, CAST(fx_rate_to_usd AS DOUBLE) AS fx_rate_to_usd,
  CAST(unit_price_orig AS DOUBLE) AS unit_price_orig, CAST(unit_price_usd AS DOUBLE) AS unit_price_usd,
  CAST(CAST(CAST(unit_price_orig AS DECIMAL(20,4)) * CAST(fx_rate_to_usd AS DECIMAL(12,8)) AS DECIMAL(18,4))
    AS DOUBLE) AS expected_usd
FROM fact WHERE currency IN ('EUR', 'GBP') ORDER BY order_item_id"""


def _top_customers(name: str, people: str, limit: str = "LIMIT 10") -> str:
    """Grouped by the label of the name and by the country as stored."""
    return f"""SELECT {name} AS customer_name, {_label('c.country')} AS country,
  COUNT(DISTINCT s.order_id) AS orders, CAST(SUM(s.line_amount_usd) AS DOUBLE) AS revenue
FROM win s LEFT JOIN {people} c ON c.customer_id = s.customer_id
GROUP BY {name}, c.country
ORDER BY SUM(s.line_amount_usd) DESC, {name}, c.country {limit}"""


def _title(text: str) -> str:
    """Capital after every non-letter, on plain letters."""
    return (
        f"list_aggregate(list_transform(regexp_extract_all(lower({text}), '([a-z]+|[^a-z]+)'), "
        "lambda s: upper(s[1]) || s[2:]), 'string_agg', '')"
    )


_CUSTOMER_LABELS = _events(
    f"""SELECT regexp_replace(trim(customer_name), '^\\s*~?\\s*unknown.*$', 'Unknown Customer', 'i')
  || ' — ' || {_title('trim(country)')} AS label, revenue
FROM ({_top_customers(_label('c.full_name'), 'customers_src')})"""
)

_FX_UPSERT_SOURCE = f"'{retail.PROVIDER} (latest base=' || base || ')'"


def _checks(rows: str, bad_date: str, clean: str, max_share: float) -> str:
    """One row per check over the relation ``rows``."""
    iso = "currency IN ('USD', 'EUR', 'GBP')"
    return f"""counted AS (
  SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE NOT {iso}) AS non_iso,
         COUNT(*) FILTER (WHERE fx_rate_to_usd IS NULL OR fx_rate_to_usd <= 0) AS bad_fx,
         COUNT(*) FILTER (WHERE quantity IS NULL OR quantity < 0) AS bad_quantity,
         COUNT(*) FILTER (WHERE unit_price_orig IS NULL OR unit_price_orig < 0) AS bad_price,
         COUNT(*) FILTER (WHERE {bad_date}) AS bad_date,
         COUNT(*) FILTER (WHERE time_key NOT BETWEEN 0 AND 1439) AS bad_time FROM {rows}),
repeated AS (SELECT order_item_id FROM {rows} GROUP BY order_item_id HAVING COUNT(*) > 1),
checks AS (
  SELECT 'fact_rows' AS check_name, n AS failed_rows FROM counted
  UNION ALL SELECT 'missing_date_keys', bad_date FROM counted
  UNION ALL SELECT 'missing_time_keys', bad_time FROM counted
  UNION ALL SELECT 'non_iso_currency', non_iso FROM counted
  UNION ALL SELECT 'invalid_fx_rate', bad_fx FROM counted
  UNION ALL SELECT 'invalid_quantity', bad_quantity FROM counted
  UNION ALL SELECT 'invalid_unit_price', bad_price FROM counted
  UNION ALL SELECT 'duplicate_items', COUNT(*) FROM repeated
  UNION ALL SELECT 'non_iso_in_clean', COUNT(*) FROM {clean} WHERE is_non_iso_currency)
SELECT check_name,
  CASE WHEN check_name = 'fact_rows' THEN 'info'
       WHEN failed_rows = 0 THEN 'ok'
       WHEN check_name = 'non_iso_currency' AND failed_rows <= {max_share} * (SELECT n FROM counted) THEN 'warning'
       ELSE 'issue' END AS level,
  failed_rows, check_name || ': ' || CAST(failed_rows AS VARCHAR)
    || CASE WHEN check_name = 'non_iso_currency' AND failed_rows > 0
         THEN (SELECT ' (' || CAST(tenths // 10 AS VARCHAR) || '.' || CAST(tenths % 10 AS VARCHAR) || '%)'
               FROM (SELECT (2000 * non_iso + n) // (2 * n) AS tenths FROM counted))
           || CASE WHEN failed_rows > {max_share} * (SELECT n FROM counted) THEN ' > {max_share:.0%} threshold' ELSE '' END
         ELSE '' END AS message
FROM checks"""


def _verdict(checks: str) -> str:
    return f"""SELECT COUNT(*) FILTER (WHERE level = 'issue') = 0 AS passed,
  coalesce(string_agg(message, '; ' ORDER BY message) FILTER (WHERE level = 'issue'), '') AS issues,
  coalesce(string_agg(message, '; ' ORDER BY message) FILTER (WHERE level = 'warning'), '') AS warnings
FROM ({checks})"""


def _calendar_misses(as_of: object) -> str:
    first = f"CAST(DATE '{as_of}' - INTERVAL 5 YEAR AS DATE)"
    last = f"CAST(DATE '{as_of}' + INTERVAL 365 DAY AS DATE)"
    return f"strptime(CAST(date_key AS VARCHAR), '%Y%m%d')::DATE NOT BETWEEN {first} AND {last}"


_FX_ONE_DAY = f"""fx_one_day AS (
  SELECT DATE '{FX_RUN_DATE}' AS fx_date, currency, CAST({USD_BASED} AS DECIMAL(18,8)) AS rate FROM currencies)"""

ORACLE: dict[str, str] = {
    "top_products": _top_products(),
    "top_products_filtered": _top_products(f"WHERE product_category IN ({_LISTED})"),
    "top_products_sql": _top_products(),
    "top_products_filtered_sql": _top_products(f"WHERE product_category IN ({_LISTED})"),
    "category_performance": _CATEGORY_PERFORMANCE,
    "category_performance_sql": _CATEGORY_PERFORMANCE,
    "revenue_by_category": _CATEGORY_PERFORMANCE,
    "revenue_by_product": _retail(
        f"SELECT product_name, {REVENUE}, {UNITS} FROM win GROUP BY product_name "
        "ORDER BY SUM(line_amount_usd) DESC, product_name LIMIT 15"
    ),
    "top10_products_all_currencies": _retail(
        f"SELECT p.name AS product_name, {UNITS}, CAST(SUM(line_amount_usd) AS DOUBLE) AS revenue_usd "
        "FROM fact f JOIN products_src p ON p.product_id = f.product_id GROUP BY p.name "
        "ORDER BY SUM(line_amount_usd) DESC, p.name LIMIT 10"
    ),
    "best_hours": _BY_HOUR,
    "best_hours_sql": _BY_HOUR,
    "revenue_by_hour": _BY_HOUR,
    "daily_revenue": _events(f", {_DAILY} SELECT sales_date, CAST(revenue AS DOUBLE) AS revenue FROM daily"),
    "daily_revenue_retail": _retail(
        f", {_DAILY} SELECT sales_date, CAST(revenue AS DOUBLE) AS revenue FROM daily"
    ),
    "daily_revenue_ma": _events(
        f", {_DAILY} SELECT sales_date, CAST(revenue AS DOUBLE) AS revenue, "
        "CAST(SUM(revenue) OVER w AS DOUBLE) / COUNT(*) OVER w AS revenue_7d_ma FROM daily "
        "WINDOW w AS (ORDER BY sales_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    ),
    "daily_revenue_cumulative": _events(
        f", {_DAILY} SELECT sales_date, CAST(SUM(revenue) OVER (ORDER BY sales_date "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumulative_revenue FROM daily"
    ),
    "weekday_hour_revenue": _events(
        f", {_WEEKDAY_HOURS} SELECT weekday_iso, hour_of_day, CAST(revenue AS DOUBLE) AS revenue FROM wh"
    ),
    "weekday_hour_matrix": _events(
        f", {_WEEKDAY_HOURS}, weekdays AS (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS weekday_iso) "
        "SELECT weekdays.weekday_iso, "
        + ", ".join(
            f"CAST(coalesce(SUM(revenue) FILTER (WHERE hour_of_day = {hour}), 0) AS DOUBLE) AS h{hour}"
            for hour in range(24)
        )
        + " FROM weekdays LEFT JOIN wh ON wh.weekday_iso = weekdays.weekday_iso GROUP BY weekdays.weekday_iso"
    ),
    "monthly_revenue_by_category": _retail(
        f", {_MONTHLY} SELECT product_category, month, CAST(revenue AS DOUBLE) AS revenue FROM monthly"
    ),
    "monthly_top5_rows": _retail(
        f""", {_MONTHLY}, biggest AS (SELECT product_category FROM monthly GROUP BY 1
  ORDER BY SUM(revenue) DESC, 1 LIMIT 5),
months AS (SELECT DISTINCT month FROM monthly WHERE product_category IN (SELECT product_category FROM biggest))
SELECT m.month, l.product_category, CAST(coalesce(x.revenue, 0) AS DOUBLE) AS revenue
FROM months m CROSS JOIN biggest l
LEFT JOIN monthly x ON x.month = m.month AND x.product_category = l.product_category"""
    ),
    "top_customers": _retail(_top_customers(_label("c.full_name"), "customers_src")),
    "top_customers_named": _retail(
        _top_customers(
            _label("c.full_name"),
            "(SELECT c_custkey AS customer_id, c_name AS full_name, n_name AS country "
            "FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)",
        )
    ),
    "top_customer_labels": _CUSTOMER_LABELS,
    "revenue_by_country": _retail(
        f"SELECT {_label('c.country')} AS country, {REVENUE} FROM win s "
        "LEFT JOIN customers_src c ON c.customer_id = s.customer_id GROUP BY c.country"
    ),
    "avg_order_value_by_country": _retail(
        f""", per_order AS (SELECT s.order_id, {_label('c.country')} AS label, SUM(line_amount_usd) AS total
  FROM win s LEFT JOIN customers_src c ON c.customer_id = s.customer_id GROUP BY s.order_id, c.country)
SELECT label AS country, CAST(SUM(total) AS DOUBLE) / COUNT(*) AS avg_order_value FROM per_order GROUP BY label"""
    ),
    "non_iso_currency_counts": _retail(
        "SELECT currency AS wrong_currency, COUNT(*) AS row_count FROM base "
        "WHERE is_non_iso_currency GROUP BY currency"
    ),
    "fx_coverage": _retail(
        "SELECT COUNT(*) AS lines_total, COUNT(*) FILTER (WHERE is_fx_fallback) AS lines_fx_fallback, "
        "COUNT(*) - COUNT(*) FILTER (WHERE is_fx_fallback) AS lines_with_rate FROM win"
    ),
    "fx_summary": _retail(
        "SELECT currency, COUNT(*) AS row_count, "
        "round(CAST(SUM(fx_rate_to_usd) AS DOUBLE) / COUNT(*), 6) AS avg_fx FROM fact GROUP BY currency"
    ),
    "fx_latest": _retail(
        "SELECT fx_date, currency, CAST(rate AS DOUBLE) AS rate_to_usd, "
        f"'{retail.PROVIDER} (latest base=USD)' AS source FROM fx ORDER BY fx_date DESC, currency LIMIT 20"
    ),
    "fact_spot_check": _retail(
        "SELECT order_item_id, currency, CAST(fx_rate_to_usd AS DOUBLE) AS fx_rate_to_usd, "
        "CAST(unit_price_orig AS DOUBLE) AS unit_price_orig, CAST(unit_price_usd AS DOUBLE) AS unit_price_usd, "
        "CAST(line_amount_usd AS DOUBLE) AS line_amount_usd FROM fact ORDER BY order_item_id LIMIT 10"
    ),
    "fx_reconciliation": _retail(f"{_RECONCILED} LIMIT 10"),
    "fx_reconciliation_all": _retail(_RECONCILED),
    "hourly_sales": _events(
        "SELECT strptime(CAST(date_key AS VARCHAR), '%Y%m%d')::DATE AS date, "
        "CAST(floor(time_key / 60.0) AS SMALLINT) AS hour, "
        "CAST(SUM(line_amount_usd) AS DOUBLE) AS revenue_usd, COUNT(*) AS items_count FROM fact GROUP BY 1, 2"
    ),
    "sales_base": _retail(f"SELECT {FACT_COLUMNS}, is_non_iso_currency, is_fx_fallback FROM base"),
    "sales_enriched": _events(
        f"SELECT {FACT_COLUMNS}, is_non_iso_currency, is_fx_fallback, product_category, product_name FROM enriched"
    ),
    "sales_clean": _events(
        f"SELECT {FACT_COLUMNS}, is_non_iso_currency, is_fx_fallback, product_category, product_name FROM clean"
    ),
    "sales_valid": _retail(
        f"SELECT {FACT_COLUMNS}, upper(coalesce(currency, 'USD')) NOT IN ('USD', 'EUR', 'GBP') AS is_non_iso_currency "
        "FROM fact WHERE upper(coalesce(currency, 'USD')) IN ('USD', 'EUR', 'GBP') "
        "AND fx_rate_to_usd > 0 AND quantity >= 0 AND unit_price_orig >= 0"
    ),
    "dim_date": """WITH bounds AS (SELECT CAST(max(o_orderdate) AS DATE) AS last_day FROM orders),
days AS (SELECT CAST(unnest(generate_series(CAST(last_day - INTERVAL 5 YEAR AS TIMESTAMP),
    CAST(last_day + INTERVAL 365 DAY AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM bounds)
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS date,
  CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS SMALLINT) AS quarter, CAST(month(d) AS SMALLINT) AS month,
  CAST(day(d) AS SMALLINT) AS day, CAST(isodow(d) AS SMALLINT) AS day_of_week, isodow(d) IN (6, 7) AS is_weekend
FROM days""",
    "insert_if_absent": """WITH held AS (SELECT DISTINCT hour(ts) * 60 + minute(ts) AS k FROM events),
minutes AS (SELECT CAST(unnest(range(1440)) AS INTEGER) AS k)
SELECT CAST(m.k AS SMALLINT) AS time_key, CAST(m.k // 60 AS SMALLINT) AS hour, CAST(m.k % 60 AS SMALLINT) AS minute,
  h.k IS NOT NULL AS had_sales FROM minutes m LEFT JOIN held h ON h.k = m.k""",
    "dim_customer": "SELECT c_custkey AS customer_id, CAST(NULL AS VARCHAR) AS full_name, "
    "CAST(NULL AS VARCHAR) AS email, n_name AS country FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
    "dim_customer_named": "SELECT c_custkey AS customer_id, c_name AS full_name, "
    "CAST(NULL AS VARCHAR) AS email, n_name AS country FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
    "dim_product": "SELECT p_partkey AS product_id, p_name AS name, p_brand AS category, p_type AS description FROM part",
    "dim_fx_rate": f"WITH {RETAIL_ORDERS}, {RETAIL_FX} SELECT fx_date, currency, CAST(rate AS DOUBLE) AS rate_to_usd, "
    f"'{retail.PROVIDER} (latest base=USD)' AS source FROM fx",
    "fx_single_date": f"WITH {RETAIL_ORDERS}, {CURRENCIES}, {_FX_ONE_DAY} SELECT fx_date, currency, "
    f"CAST(rate AS DOUBLE) AS rate_to_usd, '{retail.PROVIDER} (latest base=USD)' AS source FROM fx_one_day",
    "fx_cross_rates": f"WITH {RETAIL_ORDERS}, {CURRENCIES} "
    f"SELECT currency, CAST(CAST({EUR_BASED} AS DECIMAL(18,8)) AS DOUBLE) AS rate_to_usd FROM currencies",
    "fx_upsert": f"""WITH {RETAIL_ORDERS}, {RETAIL_FX}, based AS (
  SELECT fx_date, currency, rate, CAST({EUR_BASED} AS DECIMAL(18,8)) AS eur_rate,
         CASE WHEN fx_date = DATE '{FX_RUN_DATE}' THEN 'EUR' ELSE 'USD' END AS base FROM fx)
SELECT fx_date, currency, CAST(CASE base WHEN 'EUR' THEN eur_rate ELSE rate END AS DOUBLE) AS rate_to_usd,
  {_FX_UPSERT_SOURCE} AS source FROM based""",
    "fact_sales_item": _retail(f"SELECT {FACT_COLUMNS} FROM fact"),
    "fact_upsert": "WITH "
    + ",\n".join(
        [
            RETAIL_ORDERS,
            RETAIL_ITEMS,
            RETAIL_FX,
            _FX_ONE_DAY,
            "first_orders AS (SELECT * FROM orders_src WHERE status IN ('F', 'O'))",
            "second_orders AS (SELECT * FROM orders_src WHERE status IN ('O', 'P'))",
            _facts("first_batch", "first_orders", "fx_one_day"),
            _facts("second_batch", "second_orders"),
        ]
    )
    + """
SELECT coalesce(s.order_item_id, f.order_item_id) AS order_item_id,
  CASE WHEN s.order_item_id IS NULL THEN f.currency ELSE s.currency END AS currency,
  CAST(CASE WHEN s.order_item_id IS NULL THEN f.fx_rate_to_usd ELSE s.fx_rate_to_usd END AS DOUBLE) AS fx_rate_to_usd,
  CAST(CASE WHEN s.order_item_id IS NULL THEN f.line_amount_usd ELSE s.line_amount_usd END AS DOUBLE)
    AS line_amount_usd,
  CASE WHEN f.order_item_id IS NULL THEN 2 ELSE 1 END AS created_by_load
FROM first_batch f FULL OUTER JOIN second_batch s ON s.order_item_id = f.order_item_id""",
    "dim_upsert": "SELECT c_custkey AS customer_id, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS full_name, "
    "CAST(NULL AS VARCHAR) AS email, n_name AS country FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
    "orphan_items": f"WITH {EVENT_ITEMS}, {EVENT_DIMS} SELECT order_item_id, order_id, "
    "CAST(product_id AS BIGINT) AS product_id, CAST(quantity AS DOUBLE) AS quantity, "
    "CAST(price AS DOUBLE) AS unit_price_orig FROM items_src i "
    "WHERE NOT EXISTS (SELECT 1 FROM products_src p WHERE p.product_id = i.product_id)",
    "order_date_range": "SELECT CAST(min(o_orderdate) AS DATE) AS first_day, "
    "CAST(max(o_orderdate) AS DATE) AS last_day FROM orders",
    "distinct_currencies": f"WITH {RETAIL_ORDERS}, {CURRENCIES} SELECT currency FROM currencies",
    "distinct_categories": "SELECT DISTINCT p_brand AS category FROM part",
    "source_counts": "SELECT 'customers' AS table_name, COUNT(*) AS row_count FROM customer "
    "UNION ALL SELECT 'orders', COUNT(*) FROM orders UNION ALL SELECT 'order_items', COUNT(*) FROM lineitem "
    "UNION ALL SELECT 'product_descriptions', COUNT(*) FROM part",
    "dq_checks": _events(", " + _checks("fact", _calendar_misses(EVENTS_AS_OF), "clean", 0.5)),
    "dq_checks_raw": "WITH "
    + ",\n".join(
        [RETAIL_ORDERS, RETAIL_ITEMS, RETAIL_DIMS, RETAIL_FX, _facts("fact", keep_copies=True), VIEWS]
    )
    + ", "
    + _checks("fact", _calendar_misses(RETAIL_AS_OF), "clean", 0.1),
    "dq_duplicates": "SELECT l_orderkey * 10 + l_linenumber AS order_item_id, COUNT(*) AS row_count "
    "FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1",
}

ORACLE["dq_verdict"] = _verdict(ORACLE["dq_checks"])
ORACLE["dq_verdict_raw"] = _verdict(ORACLE["dq_checks_raw"])

ORACLE["monthly_category_matrix"] = _retail(
    f", {_MONTHLY} SELECT month, "
    + ", ".join(
        f"CAST(coalesce(SUM(revenue) FILTER (WHERE product_category = '{name}'), 0) AS DOUBLE) AS \"{name}\""
        for name in FILTERED_CATEGORIES
    )
    + f" FROM monthly WHERE product_category IN ({_LISTED}) GROUP BY month"
)
ORACLE["weekend_revenue_by_quarter"] = _retail(
    f", days AS (SELECT *, strptime(CAST(date_key AS VARCHAR), '%Y%m%d')::DATE AS day FROM base) "
    f"SELECT CAST(year(day) AS SMALLINT) AS year, CAST(quarter(day) AS SMALLINT) AS quarter, {UNITS}, {REVENUE} "
    "FROM days WHERE isodow(day) >= 6 AND quarter(day) IN (1, 4) AND NOT is_non_iso_currency GROUP BY 1, 2"
)
ORACLE["csv_round_trip"] = " UNION ALL ".join(
    f"SELECT '{report}' AS report, {label} AS label, revenue FROM ({ORACLE[name]})"
    for report, label, name in (
        ("revenue_by_category", "product_category", "revenue_by_category"),
        ("revenue_by_product_top15", "product_name", "revenue_by_product"),
        ("revenue_by_country", "country", "revenue_by_country"),
    )
)

# A first load without every fifth order; then those, and another fifth on later days, at other rates of one day.
_TWICE = ",\n".join(
    [
        RETAIL_ORDERS,
        RETAIL_ITEMS,
        CURRENCIES,
        "first_orders AS (SELECT * FROM orders_src WHERE order_id % 5 <> 0)",
        f"second_orders AS (SELECT * REPLACE (CASE WHEN order_id % 5 = 3 THEN ts + INTERVAL {MOVED_DAYS} DAY ELSE ts END AS ts)"
        " FROM orders_src WHERE order_id % 5 IN (0, 3))",
        f"first_days AS ({ORDER_DAYS.replace('orders_src', 'first_orders')})",
        f"first_fx AS (SELECT fx_date, currency, CAST({USD_BASED} AS DECIMAL(18,8)) AS rate"
        " FROM first_days CROSS JOIN currencies)",
        f"second_fx AS (SELECT fx_date, currency, CASE WHEN fx_date = DATE '{FX_RUN_DATE}'"
        f" THEN CAST({EUR_BASED} AS DECIMAL(18,8)) ELSE rate END AS rate FROM first_fx)",
        _facts("first_batch", "first_orders", "first_fx"),
        _facts("second_batch", "second_orders", "second_fx"),
        """merged AS (
  SELECT *, 1 AS created_by_load FROM first_batch
  WHERE order_item_id NOT IN (SELECT order_item_id FROM second_batch)
  UNION ALL
  SELECT *, CASE WHEN order_item_id IN (SELECT order_item_id FROM first_batch) THEN 1 ELSE 2 END FROM second_batch)""",
    ]
)
ORACLE["fact_second_load"] = f"""WITH {_TWICE}
SELECT order_item_id, date_key, currency, CAST(fx_rate_to_usd AS DOUBLE) AS fx_rate_to_usd,
  CAST(line_amount_usd AS DOUBLE) AS line_amount_usd, created_by_load FROM merged"""
ORACLE["hourly_second_load"] = f"""WITH {_TWICE}
SELECT strptime(CAST(date_key AS VARCHAR), '%Y%m%d')::DATE AS date, CAST(time_key // 60 AS SMALLINT) AS hour,
  CAST(SUM(line_amount_usd) AS DOUBLE) AS revenue_usd, COUNT(*) AS items_count FROM merged GROUP BY 1, 2"""
ORACLE["customer_second_load"] = ORACLE["dim_upsert"]
ORACLE["fx_second_load"] = f"""WITH {_TWICE}
SELECT fx_date, currency, CAST(rate AS DOUBLE) AS rate_to_usd, '{retail.PROVIDER} (latest base='
  || CASE WHEN fx_date = DATE '{FX_RUN_DATE}' THEN 'EUR' ELSE 'USD' END || ')' AS source FROM second_fx"""
ORACLE["surrogate_keys"] = f"""WITH {_TWICE}
SELECT 'fact_sales_item' AS table_name, COUNT(*) AS row_count, COUNT(*) AS numbers, COUNT(*) AS highest,
  COUNT(*) FILTER (WHERE created_by_load = 1) AS kept FROM merged
UNION ALL SELECT 'dim_customer', COUNT(*), COUNT(*), COUNT(*), COUNT(*) FROM customer
UNION ALL SELECT 'dim_product', COUNT(*), COUNT(*), COUNT(*), COUNT(*) FROM part"""

_SPOILED = ",\n".join(
    [
        RETAIL_ORDERS.replace("orders_src AS", "sound_orders AS"),
        RETAIL_ITEMS.replace("items_src AS", "sound_items AS"),
        """orders_src AS (SELECT order_id, CASE WHEN order_id % 7 <> 1 THEN customer_id END AS customer_id,
    CASE WHEN order_id % 13 = 3 THEN TIMESTAMP '1950-01-01' ELSE ts END AS ts, status,
    CASE WHEN order_id % 11 = 2 THEN 'EURO' ELSE currency END AS currency FROM sound_orders)""",
        """items_src AS (SELECT order_item_id, order_id, product_id,
    CASE WHEN order_item_id % 17 <> 4 THEN quantity END AS quantity, price FROM sound_items)""",
        "fx AS (SELECT CAST(NULL AS DATE) AS fx_date, 'USD' AS currency, CAST(1 AS DECIMAL(18,8)) AS rate)",
        _facts("fact"),
    ]
)
_BROKEN = {
    "customer_id is missing": "customer_id IS NULL",
    "quantity is missing": "quantity IS NULL",
    "currency has more than three characters": "length(currency) > 3",
    "date_key is not in the calendar": "date_key < 19600101",
}
ORACLE["load_refusals"] = f"WITH {_SPOILED}\n" + " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, COUNT(*) AS \"rows\" FROM fact WHERE {broken} HAVING COUNT(*) > 0"
    for rule, broken in _BROKEN.items()
)

# The matrix has a column for each of the five categories, named by the data.
ORACLE["monthly_top5_matrix"] = (
    "SELECT month, coalesce(COLUMNS(* EXCLUDE (month)), 0) FROM "
    f"(PIVOT ({ORACLE['monthly_top5_rows']}) ON product_category USING sum(revenue) GROUP BY month)"
)

# The stored snapshot holds the same quotes as the one in memory.
ORACLE["fx_snapshot_file"] = ORACLE["fx_cross_rates"]
