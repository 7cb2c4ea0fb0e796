"""Reference SQL (DuckDB dialect) for every registered batch query.

These are deliberately the *naive* formulations -- sliding RANGE windows,
``lead``, interval joins -- so they check the scalable Spark plans rather
than mirror them. Fixture views follow FIXTURES.md section 3; rule text comes
from the same catalogue the Spark side uses.
"""

from __future__ import annotations

from ..functions.rules import rules_for

FX_EVENTS = """
SELECT event_id,
  concat(CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS session_id,
  CAST(user_id AS STRING) AS user_id, ts AS event_timestamp,
  CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_type = 'signup' THEN 'add_to_cart'
       WHEN event_type = 'purchase' THEN 'checkout'
       WHEN event_type = 'error' THEN 'remove_from_cart' ELSE event_type END AS event_type,
  CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 59 = 0 THEN -value ELSE value END AS cart_value,
  CASE WHEN event_id % 67 = 0 THEN NULL
       ELSE concat('cat', CAST(CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 7 AS STRING)) END AS item_category
FROM events"""

FX_LABELS = """
SELECT concat(CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS session_id,
  CASE WHEN event_id % 71 = 0 THEN NULL WHEN event_id % 73 = 0 THEN 2
       WHEN event_type = 'error' THEN 1 ELSE 0 END AS will_abandon,
  ts + INTERVAL '1' HOUR * (event_id % 48) AS label_available_date
FROM events WHERE event_type IN ('purchase', 'error')"""

FX_CUSTOMERS = """
SELECT CAST(o.o_custkey AS STRING) AS user_id,
  CASE c.c_mktsegment WHEN 'BUILDING' THEN 'loyalty' WHEN 'MACHINERY' THEN 'guest' ELSE 'registered' END AS user_type,
  CASE WHEN o.o_custkey % 41 = 0 THEN NULL ELSE CAST(15 + o.o_custkey % 88 AS INT) END AS age,
  CASE o.o_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'O' END AS gender,
  CASE WHEN o.o_custkey % 37 = 0 THEN 'ESP' ELSE 'ES' END AS country,
  CASE o.o_orderstatus WHEN 'F' THEN 'desktop' WHEN 'O' THEN 'mobile' ELSE 'tablet' END AS preferred_device,
  DATE '1994-01-01' AS registration_date, o.o_orderpriority AS favourite_category,
  (o.o_orderkey % 100) / 100.0E0 AS return_rate,
  CAST(o.o_custkey % 2 AS INT) AS has_app_installed, CAST(o.o_orderkey % 2 AS INT) AS email_opt_in,
  CAST(1 AS INT) AS push_opt_in,
  CASE WHEN o.o_orderkey % 43 = 0 THEN NULL ELSE o.o_orderdate END AS user_updated_at,
  o.o_orderkey AS source_seq
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey"""


def conj(tag: str) -> str:
    return " AND ".join(f"({p})" for p in rules_for(tag).values())


def base_ctes() -> str:
    """Fixture views, routed branches and the labelled join as CTEs."""
    return f"""
fx_events AS ({FX_EVENTS}),
fx_labels AS ({FX_LABELS}),
fx_customers_raw AS ({FX_CUSTOMERS}),
fx_customers AS (
  SELECT * REPLACE (COALESCE(user_updated_at, CAST(registration_date AS TIMESTAMP)) AS user_updated_at)
  FROM fx_customers_raw),
clean_events AS (SELECT * FROM fx_events WHERE COALESCE({conj('transactions')}, FALSE)),
quarantine_events AS (SELECT * FROM fx_events WHERE NOT COALESCE({conj('transactions')}, FALSE)),
clean_labels AS (SELECT * FROM fx_labels WHERE COALESCE({conj('labels')}, FALSE)),
quarantine_labels AS (SELECT * FROM fx_labels WHERE NOT COALESCE({conj('labels')}, FALSE)),
clean_customers AS (SELECT * FROM fx_customers WHERE COALESCE({conj('customers')}, FALSE)),
quarantine_customers AS (SELECT * FROM fx_customers WHERE NOT COALESCE({conj('customers')}, FALSE)),
labelled AS (
  SELECT ev.*, lbl.will_abandon, lbl.label_available_date
  FROM clean_events ev LEFT JOIN clean_labels lbl
    ON ev.session_id = lbl.session_id
   AND lbl.label_available_date >= ev.event_timestamp
   AND lbl.label_available_date <= ev.event_timestamp + INTERVAL 30 DAY)"""


def with_base(body: str) -> str:
    return f"WITH {base_ctes()}\n{body}"


FEATURE_WINDOWS = """
WINDOW w1h AS (PARTITION BY user_id ORDER BY ts_ms RANGE BETWEEN 3600000 PRECEDING AND 1 PRECEDING),
       w24h AS (PARTITION BY user_id ORDER BY ts_ms RANGE BETWEEN 86400000 PRECEDING AND 1 PRECEDING),
       w7d AS (PARTITION BY user_id ORDER BY ts_ms RANGE BETWEEN 604800000 PRECEDING AND 1 PRECEDING),
       w30d AS (PARTITION BY user_id ORDER BY ts_ms RANGE BETWEEN 2592000000 PRECEDING AND 1 PRECEDING)"""


def features_raw(abandon_pit: bool = False) -> str:
    """Raw (unrounded) 20-column feature table over ``labelled`` as a CTE body."""
    if abandon_pit:
        # leak-free: abandoned rows of the last 30 days whose label was already
        # available one millisecond before the current row (brute force).
        abandoned = """(SELECT CAST(COUNT(*) AS BIGINT) FROM j j2
             WHERE j2.user_id = j.user_id AND j2.will_abandon = 1
               AND j2.ts_ms BETWEEN j.ts_ms - 2592000000 AND j.ts_ms - 1
               AND (epoch_us(j2.label_available_date) // 1000) <= j.ts_ms - 1)"""
    else:
        abandoned = ("CAST(COALESCE(SUM(CASE WHEN will_abandon = 1 THEN 1 ELSE 0 END) OVER w30d, 0)"
                     " AS BIGINT)")
    return f"""
j AS (SELECT *, (epoch_us(event_timestamp) // 1000) AS ts_ms FROM labelled),
f AS (
  SELECT user_id, event_timestamp,
    COUNT(session_id) OVER w1h AS count_events_1h,
    COALESCE(SUM(cart_value) OVER w1h, 0.0) AS sum_cart_value_1h,
    AVG(cart_value) OVER w1h AS avg_cart_value_1h,
    CAST(COUNT(DISTINCT item_category) OVER w1h AS INTEGER) AS distinct_categories_1h,
    COUNT(session_id) OVER w24h AS count_sessions_24h,
    COALESCE(SUM(cart_value) OVER w24h, 0.0) AS sum_cart_value_24h,
    AVG(cart_value) OVER w24h AS avg_cart_value_24h,
    MAX(cart_value) OVER w24h AS max_cart_value_24h,
    CAST(COUNT(DISTINCT item_category) OVER w24h AS INTEGER) AS distinct_categories_24h,
    CAST(COALESCE(SUM(CASE WHEN event_type = 'add_to_cart' THEN 1 ELSE 0 END) OVER w24h, 0) AS BIGINT)
      AS count_add_to_cart_24h,
    COUNT(session_id) OVER w7d AS count_events_7d,
    COALESCE(SUM(cart_value) OVER w7d, 0.0) AS sum_cart_value_7d,
    CAST(COUNT(DISTINCT item_category) OVER w7d AS INTEGER) AS distinct_categories_7d,
    COUNT(session_id) OVER w30d AS count_events_30d,
    COALESCE(SUM(cart_value) OVER w30d, 0.0) AS sum_cart_value_30d,
    AVG(cart_value) OVER w30d AS avg_cart_value_30d,
    {abandoned} AS num_abandoned_confirmed_30d
  FROM j
  {FEATURE_WINDOWS}),
features AS (
  SELECT *, COALESCE(sum_cart_value_24h / (avg_cart_value_30d + 1e-6), 1.0)
              AS cart_value_24h_vs_avg_30d_ratio
  FROM f)"""


ROUNDED_FEATURES = """
SELECT user_id, event_timestamp, count_events_1h,
  ROUND(sum_cart_value_1h, 9) AS sum_cart_value_1h, ROUND(avg_cart_value_1h, 9) AS avg_cart_value_1h,
  distinct_categories_1h, count_sessions_24h,
  ROUND(sum_cart_value_24h, 9) AS sum_cart_value_24h, ROUND(avg_cart_value_24h, 9) AS avg_cart_value_24h,
  ROUND(max_cart_value_24h, 9) AS max_cart_value_24h, distinct_categories_24h, count_add_to_cart_24h,
  count_events_7d, ROUND(sum_cart_value_7d, 9) AS sum_cart_value_7d, distinct_categories_7d,
  count_events_30d, ROUND(sum_cart_value_30d, 9) AS sum_cart_value_30d,
  ROUND(avg_cart_value_30d, 9) AS avg_cart_value_30d, num_abandoned_confirmed_30d,
  ROUND(cart_value_24h_vs_avg_30d_ratio, 9) AS cart_value_24h_vs_avg_30d_ratio
FROM features"""


def behavior_features(abandon_pit: bool = False) -> str:
    return f"WITH {base_ctes()},{features_raw(abandon_pit)}\n{ROUNDED_FEATURES}"


def feature_subset(columns: list[str], abandon_pit: bool = False) -> str:
    sel = ", ".join(["user_id", "event_timestamp"] + [
        f"ROUND({c}, 9) AS {c}" if c.startswith(("sum_", "avg_", "max_", "cart_")) else c
        for c in columns])
    return f"WITH {base_ctes()},{features_raw(abandon_pit)}\nSELECT {sel} FROM features"
