"""The registered queries as SQL over the given tables, written from the tables and not from the transforms."""

from __future__ import annotations

AS_OF = "DATE '2001-08-01'"
FIRST, LAST = "DATE '2001-01-01'", "DATE '2001-06-30'"

_LINES = """ln AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
    l_shipdate, l_returnflag, l_linestatus, l_discount, l_tax) AS line_id,
    CAST(l_extendedprice AS DECIMAL(20,2)) AS price, CAST(l_quantity AS BIGINT) AS qty
  FROM lineitem)"""
_ORDERS = """po AS (
  SELECT o_orderkey AS k, 'shop:' || o_orderkey AS order_key, CASE WHEN o_custkey % 50 <> 0 THEN 'shop:' || o_custkey END AS customer_key,
    CASE WHEN o_orderkey % 5 = 0 THEN 'USD' ELSE 'EUR' END AS currency, n_name AS country, r_name AS region, o_orderdate AS placed, o_orderstatus AS flag,
    CASE WHEN o_orderkey % 29 = 0 THEN 'CANCELLED' WHEN o_orderstatus = 'P' THEN 'REFUNDED' ELSE 'CONFIRMED' END AS status, o_custkey AS customer
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""
# Each delivered version: 0 marks the clashing second payload of version 1.
_CHANGES = """has AS (SELECT DISTINCT l_orderkey FROM lineitem),
ch AS (
  SELECT *, 1 AS version, 0 AS variant, country AS country_sent FROM po
  UNION ALL SELECT *, 2, 0, country FROM po WHERE k % 7 = 0
  UNION ALL SELECT *, 1, 1, country || ' (other)' FROM po WHERE k % 103 = 0),
dl AS (SELECT *, 1 AS delivery FROM ch UNION ALL SELECT *, 2 FROM ch WHERE k % 11 = 0),
rj AS (
  SELECT order_key, k, CASE WHEN bad AND clash THEN 'conflicting payloads for the same order version; invalid purchase snapshot'
    WHEN bad THEN 'invalid purchase snapshot' ELSE 'conflicting payloads for the same order version' END AS reason
  FROM (SELECT order_key, k, k % 97 = 0 OR (k % 101 = 0 AND k IN (SELECT l_orderkey FROM has)) AS bad, k % 103 = 0 AS clash FROM po)
  WHERE bad OR clash)"""
_ITEMS = """it AS (
  SELECT o.order_key, o.customer_key, o.currency, o.country, o.placed AS purchased_at, CASE WHEN k % 7 = 0 THEN 2 ELSE 1 END AS version,
    CAST(line_id AS VARCHAR) AS line_id, 'shop:' || l_partkey AS product_key, l_linestatus AS category, qty AS quantity, price AS gross_amount,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned_quantity,
    CASE WHEN l_returnflag <> 'R' THEN 0 WHEN l_quantity = 1 THEN price ELSE 1 END::DECIMAL(20,2) AS returned_amount
  FROM po o JOIN ln ON l_orderkey = k
  WHERE status IN ('CONFIRMED', 'REFUNDED') AND k NOT IN (SELECT k FROM rj) AND NOT (k % 7 = 0 AND l_linenumber = 1)),
im AS (SELECT *, gross_amount - returned_amount AS net_amount, CAST(purchased_at AS DATE) AS metric_date FROM it)"""
_BASE = f"WITH {_LINES},\n{_ORDERS},\n{_CHANGES},\n{_ITEMS}"
_SUMS = ", ".join(f"sum({c}) AS {c}" for c in ("gross_amount", "returned_amount", "net_amount"))
_DAILY = f"""{_BASE},
cd AS (SELECT customer_key, currency, metric_date, count(DISTINCT order_key) AS orders, sum(quantity) AS units, {_SUMS}
  FROM im WHERE customer_key IS NOT NULL GROUP BY ALL),
pd AS (SELECT product_key, currency, metric_date, count(DISTINCT order_key) AS orders, sum(quantity) AS units, sum(returned_quantity) AS returned_units, {_SUMS}
  FROM im GROUP BY ALL)"""
_WINDOWS = ", ".join(
    f"CAST(sum(CASE WHEN metric_date > {AS_OF} - {d} THEN {m} ELSE 0 END) AS {t}) AS {m}_{d}d" for d in (30, 90, 365) for m, t in (("orders", "BIGINT"), ("net_amount", "DOUBLE"))
)
_PROFILES = f"""{_DAILY},
pf AS (SELECT customer_key, currency, min(metric_date) AS first_purchase, max(metric_date) AS last_purchase, CAST(sum(orders) AS BIGINT) AS lifetime_orders, {_WINDOWS},
    date_diff('day', max(metric_date), {AS_OF}) AS recency_days FROM cd WHERE metric_date <= {AS_OF} GROUP BY ALL),
pr AS (SELECT *, CASE WHEN recency_days > 90 THEN 'Inactive' WHEN orders_90d >= 3 THEN 'Repeat' WHEN lifetime_orders = 1 THEN 'New' ELSE 'Returning' END AS segment FROM pf)"""
_COHORTS = f"""{_DAILY},
fm AS (SELECT customer_key, currency, date_trunc('month', min(metric_date))::DATE AS cohort_month FROM cd GROUP BY ALL),
sz AS (SELECT cohort_month, currency, count(*) AS cohort_size FROM fm GROUP BY ALL),
ac AS (SELECT cohort_month, currency, date_trunc('month', metric_date)::DATE AS activity_month, count(DISTINCT customer_key) AS active
  FROM cd JOIN fm USING (customer_key, currency) GROUP BY ALL),
gr AS (SELECT cohort_month, currency, cohort_size, CAST(unnest(generate_series(cohort_month::TIMESTAMP, date_trunc('month', {AS_OF})::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS activity_month FROM sz),
co AS (SELECT gr.*, coalesce(active, 0) AS active_customers, date_diff('month', cohort_month, activity_month) AS month_number,
    CAST(CAST(coalesce(active, 0) / cohort_size AS DECIMAL(8,6)) AS DOUBLE) AS retention, last_day(activity_month) <= {AS_OF} AS complete
  FROM gr LEFT JOIN ac USING (cohort_month, currency, activity_month))"""


def _text(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c.split('.')[-1]}" for c in columns)


def _double(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c.split('.')[-1]}" for c in columns)


def _long(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS BIGINT) AS {c.split('.')[-1]}" for c in columns)


def _time(c: str, name: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {name}"


_MONEY = _double("gross_amount", "returned_amount", "net_amount")

_TOTALS = "tt AS (SELECT l_orderkey, sum(price) AS total, min(l_suppkey) AS seller, min(line_id) AS f FROM ln GROUP BY 1)"
_STATE = f"""WITH {_LINES}, {_ORDERS}, {_TOTALS},
so AS (SELECT CAST(k AS VARCHAR) AS order_id, CAST(seller AS VARCHAR) AS seller_id, CAST(customer AS VARCHAR) AS customer_token, substr(region, 1, 2) AS market, currency,
    coalesce(total, 0)::DECIMAL(20,2) AS gross_amount, CASE WHEN flag = 'P' THEN 'REFUNDED' WHEN k % 29 = 0 THEN 'CANCELLED' ELSE 'CONFIRMED' END AS status,
    placed AS created_at, placed + CASE WHEN flag = 'P' THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS updated_at, CASE WHEN flag = 'P' THEN 3 ELSE 2 END AS producer_sequence
  FROM po LEFT JOIN tt ON l_orderkey = k)"""
#: Lines of an order, as events see them: one at least.
_CREATED = "ct AS (SELECT l_orderkey, count(*) AS m FROM lineitem GROUP BY 1)"
#: Events of the orders that a condition keeps, all together.
_EVENTS_OF = "(SELECT CAST(sum(greatest(coalesce(m, 0), 1) + 1 + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) FROM orders LEFT JOIN ct ON l_orderkey = o_orderkey WHERE {})"
_STEPS = f"""WITH {_ORDERS}, {_CREATED}, st AS (
  SELECT k, placed, 1 AS n, 'CREATED' AS status, unnest(generate_series(1, greatest(m, 1))) AS line FROM po LEFT JOIN ct ON l_orderkey = k
  UNION ALL SELECT k, placed, 2, CASE WHEN k % 29 = 0 THEN 'CANCELLED' ELSE 'CONFIRMED' END, 1 FROM po
  UNION ALL SELECT k, placed, 3, 'REFUNDED', 1 FROM po WHERE flag = 'P')"""
_OLINES = f"""WITH {_LINES}, {_ORDERS},
ol AS (SELECT 'order-' || k || '-1' || CASE WHEN line_id > 1 THEN '-' || line_id ELSE '' END AS event_id, CAST(k AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku, CAST(l_suppkey % 5 AS VARCHAR) AS location_id,
    qty AS quantity, placed AS created_at FROM po JOIN ln ON l_orderkey = k)"""
_STOCK = f"""{_OLINES},
mv AS (SELECT l_partkey AS sku, l_suppkey % 5 AS location_id, CAST(l_shipdate AS DATE) AS date, CASE WHEN l_returnflag = 'R' THEN 0 ELSE -qty END AS d FROM ln
  UNION ALL SELECT l_partkey, l_suppkey % 5, CAST(min(l_shipdate) AS DATE), 100 FROM ln GROUP BY 1, 2),
dd AS (SELECT CAST(sku AS VARCHAR) AS sku, CAST(location_id AS VARCHAR) AS location_id, date, CAST(sum(d) AS BIGINT) AS daily_delta FROM mv GROUP BY ALL),
sk AS (SELECT *, CAST(sum(daily_delta) OVER (PARTITION BY sku, location_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS available_units FROM dd)"""
_HISTORY = """WITH cc AS (
  SELECT CAST(user_id AS VARCHAR) AS customer_id, 't' || user_id AS email_token, ['IT', 'DE', 'FR'][event_id % 3 + 1] AS country,
    CASE event_type WHEN 'signup' THEN 'PLUS' WHEN 'purchase' THEN 'PREMIUM' ELSE 'STANDARD' END AS customer_tier, event_type = 'error' AS is_deleted,
    date_trunc('hour', ts) AS valid_from, CAST(event_id AS VARCHAR) AS source_event_id, event_id AS source_lsn FROM events),
o1 AS (SELECT * FROM cc QUALIFY row_number() OVER (PARTITION BY customer_id, valid_from ORDER BY source_lsn DESC) = 1),
o2 AS (SELECT *, lag(country || customer_tier || is_deleted) OVER (PARTITION BY customer_id ORDER BY valid_from) AS b FROM o1),
o3 AS (SELECT * EXCLUDE (b) FROM o2 WHERE b IS NULL OR b <> country || customer_tier || is_deleted),
hi AS (SELECT *, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS valid_to FROM o3)"""
_RAW = """WITH rw AS (
  SELECT event_id AS e, event_type AS t, user_id % 3 AS p, event_id * 2 AS o, ts FROM events
  UNION ALL SELECT event_id, event_type, user_id % 3, event_id * 2 + 1, ts FROM events WHERE event_id % 17 = 0),
jd AS (SELECT *, CASE WHEN e % 41 = 0 THEN 'DESERIALIZATION_FAILED' WHEN e % 43 = 0 THEN 'OCCURRED_AT_INVALID' END AS err FROM rw)"""
_RETAIL = f"""WITH {_LINES}, {_ORDERS},
rl AS (SELECT k, line_id, customer, country AS home, CASE WHEN k % 53 = 0 AND line_id = 2 THEN 'Elsewhere' ELSE country END AS country, placed, qty, l_partkey AS part,
    CAST(p_retailprice AS DECIMAL(20,2)) AS price,
    CASE WHEN k % 19 = 0 THEN 'unlinked_cancellation' WHEN l_partkey % 23 = 0 THEN 'non_product_or_missing_invoice' WHEN l_partkey % 37 <> 0 AND l_partkey % 41 = 0 THEN 'invalid_value'
      WHEN k % 31 = 0 THEN 'invalid_quantity' WHEN l_partkey % 37 = 0 THEN 'non_positive_price' ELSE 'accepted' END AS reason
  FROM po JOIN ln ON l_orderkey = k LEFT JOIN part ON p_partkey = l_partkey),
iv AS (SELECT k, count(*) AS lines, sum(CAST(price * qty AS DECIMAL(20,2))) AS amount, count(DISTINCT country) AS heads, min(country) AS country, min(customer) AS customer, min(placed) AS placed
  FROM rl WHERE reason = 'accepted' GROUP BY 1)"""

ORACLE_SQL: dict[str, str] = {
    "customer_profiles": f"{_PROFILES} SELECT customer_key, currency, {_text('first_purchase', 'last_purchase')}, lifetime_orders, orders_30d, net_amount_30d, orders_90d, net_amount_90d, orders_365d, net_amount_365d, recency_days, segment, '2001-08-01' AS as_of_date, 'purchase-v1' AS policy_version FROM pr",
    "customer_daily": f"{_DAILY} SELECT customer_key, currency, {_text('metric_date')}, orders, {_long('units')}, {_MONEY} FROM cd",
    "product_daily": f"{_DAILY} SELECT product_key, currency, {_text('metric_date')}, orders, {_long('units', 'returned_units')}, {_MONEY} FROM pd",
    "customer_cohorts": f"{_COHORTS} SELECT {_text('cohort_month', 'activity_month')}, currency, cohort_size, active_customers, month_number, retention, complete FROM co",
    "retention_matrix": f"{_COHORTS} SELECT {_text('cohort_month')}, currency, max(cohort_size) AS cohort_size, CAST(min(CAST(complete AS INT)) AS BIGINT) AS all_complete, "
    + ", ".join(f"max(CASE WHEN month_number = {i} THEN retention END) AS m{i}" for i in range(13)) + " FROM co GROUP BY cohort_month, currency",
    "latest_purchases": f"{_BASE} SELECT order_key, customer_key, CAST(CASE WHEN k % 7 = 0 THEN 2 ELSE 1 END AS BIGINT) AS version, CASE WHEN k % 97 = 0 THEN 'eur' ELSE currency END AS currency, "
    "CASE WHEN k % 103 = 0 AND k % 7 <> 0 AND sha256('shop:' || k || ':1:other') > sha256('shop:' || k || ':1') THEN country || ' (other)' ELSE country END AS country, "
    f"{_time('placed', 'purchased_at')}, status, (SELECT count(*) FROM ln WHERE l_orderkey = k AND NOT (k % 7 = 0 AND l_linenumber = 1)) AS lines, "
    "(SELECT count(*) FROM ln WHERE l_orderkey = k AND NOT (k % 7 = 0 AND l_linenumber = 1) AND l_returnflag = 'R') AS returned_lines FROM po",
    "purchase_items": f"{_BASE} SELECT order_key, customer_key, currency, country, {_time('purchased_at', 'purchased_at')}, {_long('version')}, line_id, product_key, category, quantity, {_long('returned_quantity')}, {_MONEY} FROM im",
    "rejected_purchases": f"{_BASE} SELECT order_key, {_long('version')}, country_sent AS country, reason FROM dl JOIN rj USING (order_key)",
    "accepted_purchases": f"{_BASE} SELECT order_key, {_long('version')}, status FROM dl WHERE k NOT IN (SELECT k FROM rj)",
    "rejection_evidence": f"{_BASE} SELECT order_key, {_long('version')}, country_sent AS country, reason, '3' AS source_snapshot FROM ch JOIN rj USING (order_key)",
    "newest_rejections": f"{_BASE} SELECT order_key, {_long('version')}, country_sent AS country, reason, strftime(known, '%Y-%m-%d %H:%M:%S') AS known_at FROM ("
    "SELECT *, placed + INTERVAL 2 DAY + CASE WHEN ch.k % 14 = 0 AND version = 2 THEN INTERVAL (-1) HOUR WHEN version = 2 THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS known FROM ch JOIN rj USING (order_key)) "
    "ORDER BY known DESC, order_key, version, country_sent LIMIT 50",
    "contract_violations": f"{_BASE} SELECT rule, count(*) AS snapshots FROM (SELECT 'CURRENCY' AS rule FROM dl WHERE k % 97 = 0 UNION ALL "
    "SELECT 'ITEM_VALUES' FROM dl WHERE k % 101 = 0 AND EXISTS (SELECT 1 FROM ln WHERE l_orderkey = k AND NOT (version = 2 AND l_linenumber = 1)) "
    ") GROUP BY 1",
    "envelope_violations": f"{_RAW} SELECT rule, count(*) AS events FROM (SELECT unnest(CASE WHEN e % 41 = 0 THEN ['EVENT_ID_LENGTH', 'EVENT_TYPE_PATTERN', 'EVENT_DOMAIN', 'EVENT_VERSION', 'TRACE_LENGTH'] ELSE ['EVENT_DOMAIN'] END) AS rule FROM jd) GROUP BY 1",
    "purchase_round_trip": f"{_BASE} SELECT currency, count(*) AS lines, CAST(sum(net_amount) AS DOUBLE) AS net_amount FROM im GROUP BY 1",
    "segment_sizes": f"{_PROFILES} SELECT segment, count(*) AS customers FROM pr WHERE currency = 'EUR' GROUP BY 1",
    "dashboard_segments": f"{_PROFILES} SELECT segment, count(*) AS customers FROM pr WHERE currency = 'EUR' GROUP BY 1",
    "summary_90d": f"{_PROFILES} SELECT count(*) AS customers, CAST(sum(orders_90d) AS BIGINT) AS orders, round(sum(net_amount_90d), 2) AS net_amount, count(*) FILTER (orders_90d >= 2) AS repeat_customers FROM pr WHERE currency = 'EUR'",
    "summary_window": f"{_DAILY} SELECT count(*) AS customers, CAST(sum(o) AS BIGINT) AS orders, CAST(sum(n) AS DOUBLE) AS net_amount, count(*) FILTER (o >= 2) AS repeat_customers FROM "
    f"(SELECT customer_key, sum(orders) AS o, sum(net_amount) AS n FROM cd WHERE currency = 'EUR' AND metric_date BETWEEN {FIRST} AND {LAST} GROUP BY 1)",
    "customer_page": f"{_PROFILES} SELECT customer_key, lifetime_orders, net_amount_365d, segment FROM pr WHERE currency = 'EUR' AND customer_key > 'shop:2' ORDER BY customer_key LIMIT 51",
    "customer_page_window": f"{_PROFILES} SELECT customer_key, segment, {_text('last_purchase')}, CAST(o AS BIGINT) AS orders, CAST(n AS DOUBLE) AS net_amount FROM pr JOIN "
    f"(SELECT customer_key, sum(orders) AS o, sum(net_amount) AS n FROM cd WHERE currency = 'EUR' AND metric_date BETWEEN {FIRST} AND {LAST} GROUP BY 1) USING (customer_key) "
    "WHERE currency = 'EUR' AND customer_key > 'shop:2' ORDER BY customer_key LIMIT 51",
    "product_totals": f"{_DAILY} SELECT product_key, CAST(sum(orders) AS BIGINT) AS orders, CAST(sum(units) AS BIGINT) AS units, CAST(sum(returned_units) AS BIGINT) AS returned_units, CAST(sum(gross_amount) AS DOUBLE) AS gross_amount, CAST(sum(net_amount) AS DOUBLE) AS net_amount "
    f"FROM pd WHERE currency = 'EUR' AND metric_date BETWEEN {FIRST} AND {LAST} GROUP BY 1",
    "customer_detail": f"{_DAILY} SELECT customer_key, currency, {_text('metric_date')}, orders, {_long('units')}, {_MONEY} FROM cd WHERE customer_key = 'shop:7' AND currency = 'EUR' ORDER BY cd.metric_date DESC LIMIT 366",
    "latest_cohorts": f"{_COHORTS} SELECT {_text('cohort_month', 'activity_month')}, currency, cohort_size, active_customers, month_number, retention FROM co "
    f"WHERE currency = 'EUR' AND co.cohort_month >= date_trunc('month', {AS_OF}) - INTERVAL 23 MONTH AND month_number <= 12 ORDER BY co.cohort_month, month_number LIMIT 313",
    "conform_orders": f"{_STATE} SELECT order_id, seller_id, customer_token, market, currency, {_double('gross_amount')}, status, {_time('created_at', 'created_at')}, {_time('updated_at', 'updated_at')}, {_long('producer_sequence')} FROM so",
    "order_status_history": f"{_STEPS} SELECT 'order-' || k || '-' || n || CASE WHEN line > 1 THEN '-' || line ELSE '' END AS event_id, CAST(k AS VARCHAR) AS order_id, status, strftime(placed + (n - 1) * INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS occurred_at FROM st",
    "order_lines": f"{_OLINES} SELECT event_id, order_id, sku, location_id, quantity, {_time('created_at', 'created_at')} FROM ol",
    "conform_payments": f"WITH {_LINES}, {_ORDERS}, {_TOTALS} SELECT 'p' || k AS payment_id, CAST(k AS VARCHAR) AS order_id, CASE WHEN k % 47 = 0 THEN 'GBP' ELSE currency END AS currency, "
    "CAST(coalesce(total, 0) + CASE WHEN k % 41 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS amount, CASE WHEN flag = 'P' THEN 'REVERSED' WHEN k % 43 = 0 THEN 'AUTHORIZED' WHEN flag = 'O' THEN 'FAILED' ELSE 'CAPTURED' END AS status, "
    "strftime(placed + CASE WHEN flag = 'P' THEN INTERVAL 3 HOUR WHEN k % 43 = 0 THEN INTERVAL 1 HOUR ELSE INTERVAL 2 HOUR END, '%Y-%m-%d %H:%M:%S') AS updated_at FROM po LEFT JOIN tt ON l_orderkey = k",
    "conform_shipments": "SELECT 's' || l_orderkey AS shipment_id, CAST(l_orderkey AS VARCHAR) AS order_id, CASE WHEN l_orderkey % 37 = 0 THEN 'EXCEPTION' ELSE 'DELIVERED' END AS status, "
    "strftime(any_value(o_orderdate) + INTERVAL 30 DAY, '%Y-%m-%d %H:%M:%S') AS promised_at, CASE WHEN l_orderkey % 37 <> 0 THEN strftime(min(l_shipdate) + INTERVAL 2 DAY, '%Y-%m-%d %H:%M:%S') END AS delivered_at, "
    "strftime(min(l_shipdate) + INTERVAL 2 DAY, '%Y-%m-%d %H:%M:%S') AS updated_at FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey",
    "inventory_daily": f"{_STOCK} SELECT sku, location_id, {_text('date')}, daily_delta, available_units, available_units <= 0 AS is_stockout FROM sk",
    "daily_kpis": f"{_STATE} SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS metric_date, market, 'UNCLASSIFIED' AS seller_tier, currency, count(*) AS order_count, CAST(sum(gross_amount) AS DOUBLE) AS gmv, "
    "CAST(sum(CASE WHEN status NOT IN ('CANCELLED', 'REFUNDED') THEN gross_amount ELSE 0 END) AS DOUBLE) AS net_revenue, count(*) FILTER (status = 'CANCELLED') AS cancelled_orders, "
    "CAST(CAST(count(*) FILTER (status = 'CANCELLED') / count(*) AS DECIMAL(12,6)) AS DOUBLE) AS cancellation_rate FROM so GROUP BY 1, 2, 3, 4",
    "daily_kpis_tiered": f"{_STATE} SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS metric_date, market, coalesce(CASE WHEN s_suppkey % 4 <> 3 THEN CASE WHEN s_acctbal > 5000 THEN 'GOLD' ELSE 'BASIC' END END, 'UNCLASSIFIED') AS seller_tier, currency, "
    "count(*) AS order_count, CAST(sum(gross_amount) AS DOUBLE) AS gmv, CAST(sum(CASE WHEN status NOT IN ('CANCELLED', 'REFUNDED') THEN gross_amount ELSE 0 END) AS DOUBLE) AS net_revenue, "
    "count(*) FILTER (status = 'CANCELLED') AS cancelled_orders, CAST(CAST(count(*) FILTER (status = 'CANCELLED') / count(*) AS DECIMAL(12,6)) AS DOUBLE) AS cancellation_rate "
    "FROM so LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = seller_id GROUP BY 1, 2, 3, 4",
    "market_overview": f"{_STATE} SELECT market, currency, count(*) AS orders, CAST(sum(gross_amount) AS DOUBLE) AS gmv FROM so GROUP BY 1, 2",
    "layer_counts": f"{_STATE}, {_CREATED} SELECT {_EVENTS_OF.format('true')} AS bronze, (SELECT count(*) FROM so) AS silver, "
    "(SELECT count(*) FROM (SELECT DISTINCT CAST(created_at AS DATE), market, currency FROM so)) AS gold",
    "demand_features": f"{_STOCK}, dm AS (SELECT sku, location_id, CAST(created_at AS DATE) AS date, CAST(sum(quantity) AS BIGINT) AS demand_units FROM ol GROUP BY ALL), "
    "fe AS (SELECT *, lag(demand_units, 1) OVER w AS demand_lag_1, lag(demand_units, 7) OVER w AS demand_lag_7, avg(demand_units) OVER (PARTITION BY sku, location_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS demand_avg_7, "
    "avg(demand_units) OVER (PARTITION BY sku, location_id ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS demand_avg_28 FROM dm WINDOW w AS (PARTITION BY sku, location_id ORDER BY date)) "
    "SELECT sku, location_id, CAST(date AS VARCHAR) AS forecast_date, demand_units, demand_lag_1, demand_lag_7, demand_avg_7, demand_avg_28, available_units, available_units <= 0 AS is_stockout FROM fe LEFT JOIN sk USING (sku, location_id, date)",
    "customer_history": f"{_HISTORY} SELECT customer_id, email_token, country, customer_tier, is_deleted, {_time('valid_from', 'valid_from')}, source_event_id, source_lsn, {_time('valid_to', 'valid_to')}, valid_to IS NULL AS is_current FROM hi",
    "history_overlaps": f"{_HISTORY}, mo AS (SELECT * REPLACE (CASE WHEN source_lsn % 5 = 0 THEN valid_to + INTERVAL 2 DAY ELSE valid_to END AS valid_to) FROM hi) "
    "SELECT r.customer_id, strftime(r.valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from, r.source_event_id FROM mo r WHERE EXISTS (SELECT 1 FROM mo l WHERE l.customer_id = r.customer_id AND l.valid_from < r.valid_from AND (l.valid_to IS NULL OR r.valid_from < l.valid_to))",
    "event_routing": f"{_RAW} SELECT t AS source_topic, p AS source_partition, o AS source_offset, coalesce(err, 'ACCEPTED') AS code FROM jd",
    "quarantined_events": f"{_RAW} SELECT t AS source_topic, p AS source_partition, o AS source_offset, err AS error_code, CASE WHEN e % 41 = 0 THEN "
    "'DESERIALIZATION_FAILED,EVENT_ID_MISSING,EVENT_TYPE_MISSING,OCCURRED_AT_INVALID,PARTITION_KEY_MISSING,PAYLOAD_MISSING' ELSE 'OCCURRED_AT_INVALID' END AS error_details, 'PENDING' AS remediation_status FROM jd WHERE err IS NOT NULL",
    "quality_flags": f"{_RAW} SELECT 'event-' || lpad(CAST(e AS VARCHAR), 8, '0') AS event_id, o AS source_offset, unnest(list_filter([CASE WHEN e % 67 = 0 THEN 'INVALID_CURRENCY' END, CASE WHEN e % 59 = 0 THEN 'PRODUCED_BEFORE_OCCURRED' END, "
    "CASE WHEN e % 61 = 0 THEN 'INVALID_AMOUNT' END, CASE WHEN e % 71 = 0 THEN 'INVALID_QUANTITY' END], lambda x: x IS NOT NULL)) AS flag FROM jd WHERE err IS NULL",
    "quality_report": f"{_STATE} SELECT 'orders' AS dataset, gate, CAST(n AS BIGINT) AS failures FROM (SELECT unnest(['order_id_not_null', 'currency_not_null', 'status_domain', 'gross_amount_non_negative', 'order_id_unique']) AS gate, unnest([0, "
    + ", ".join(f"(SELECT sum(CASE WHEN order_id::BIGINT % 73 = 0 THEN 2 ELSE 1 END) FROM so WHERE order_id::BIGINT % {m} = 0)" for m in (83, 89, 79))
    + ", (SELECT count(*) FROM so WHERE order_id::BIGINT % 73 = 0)]) AS n) UNION ALL SELECT 'shipments', unnest(['shipment_id_not_null', 'order_id_not_null', 'status_domain', 'shipment_id_unique']), 0 "
    "UNION ALL SELECT 'customers', unnest(['customer_id_not_null', 'valid_from_not_null', 'customer_id_valid_from_unique', 'exactly_one_current_row', 'non_overlapping_intervals']), 0",
    "upsert_guarded": f"{_STATE} SELECT order_id, status, currency, {_double('gross_amount')}, {_time('updated_at', 'updated_at')} FROM so",
    "insert_absent": f"{_STATE} SELECT order_id, CASE WHEN order_id::BIGINT % 2 = 0 THEN status ELSE 'ADDED' END AS status, currency FROM so",
    "replace_groups": f"{_BASE} SELECT order_key, {_long('version')}, line_id, product_key, quantity, {_double('gross_amount', 'net_amount')} FROM im",
    "group_changes": f"{_BASE} SELECT order_key, CAST(line_id AS VARCHAR) AS line_id, l_linenumber = 1 AS removed FROM po JOIN ln ON l_orderkey = k WHERE k % 7 = 0 AND status IN ('CONFIRMED', 'REFUNDED') AND k NOT IN (SELECT k FROM rj)",
    "payment_findings": f"WITH {_LINES}, {_ORDERS}, {_TOTALS}, ct AS (SELECT TIMESTAMP '2001-08-01 01:20:00' AS cut), "
    "c AS (SELECT k, currency, placed, cut, coalesce(total, 0)::DECIMAL(20,2) AS total, k % 43 <> 0 AND flag <> 'O' AND placed + INTERVAL 2 HOUR <= cut AS cap, CASE WHEN k % 47 = 0 THEN 'GBP' ELSE currency END AS pc "
    "FROM po CROSS JOIN ct LEFT JOIN tt ON l_orderkey = k WHERE flag <> 'P' AND k % 29 <> 0 AND placed + INTERVAL 1 HOUR <= cut), "
    "ac AS (SELECT k, pc AS cur, total + CASE WHEN k % 41 = 0 THEN 1 ELSE 0 END - CASE WHEN k % 37 = 0 THEN 1 ELSE 0 END AS amount FROM c WHERE cap AND NOT (k % 31 = 0 AND placed + INTERVAL 4 HOUR <= cut) "
    "UNION ALL SELECT k, CASE WHEN k % 74 = 0 THEN 'CHF' ELSE pc END, 1 FROM c WHERE cap AND k % 37 = 0), "
    "g AS (SELECT k, cur, sum(amount) AS s FROM ac GROUP BY 1, 2), "
    "h AS (SELECT c.k, c.currency, c.total, any_value(date_diff('minute', placed + INTERVAL 1 HOUR, cut)) AS age, count(g.k) AS n, max(CASE WHEN g.cur = c.currency THEN s END) AS paid, coalesce(bool_or(g.cur <> c.currency), false) AS other FROM c LEFT JOIN g ON g.k = c.k GROUP BY 1, 2, 3), "
    "f AS (SELECT *, CASE WHEN other THEN 'CURRENCY_MISMATCH' WHEN n = 0 AND total > 0 AND age >= 30 THEN 'MISSING_CAPTURE' WHEN paid <> total THEN 'AMOUNT_MISMATCH' END AS finding FROM h) "
    "SELECT CAST(k AS VARCHAR) AS order_id, currency, CAST(total AS DOUBLE) AS gross_amount, CAST(paid AS DOUBLE) AS paid_amount, finding, "
    "CASE WHEN finding = 'CURRENCY_MISMATCH' OR (finding = 'MISSING_CAPTURE' AND age >= 120) OR (finding = 'AMOUNT_MISMATCH' AND abs(paid - total) >= 100) THEN 'HIGH' ELSE 'NORMAL' END AS priority FROM f WHERE finding IS NOT NULL",
    "payment_state_mismatches": f"WITH {_ORDERS} SELECT 'p' || k AS payment_id, CASE WHEN flag = 'P' THEN 'REVERSED' WHEN k % 43 = 0 THEN 'AUTHORIZED' WHEN flag = 'O' THEN 'FAILED' ELSE 'CAPTURED' END AS event_status, "
    "CASE WHEN k % 53 <> 0 THEN 'LOST' END AS status FROM po WHERE k % 53 = 0 OR k % 59 = 0",
    "newest_errors": f"{_RAW} SELECT t AS topic, p AS partition, o AS \"offset\", strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, CASE WHEN e % 41 = 0 THEN 20 ELSE 25 END::BIGINT AS bytes, e % 41 <> 0 AS truncated FROM rw WHERE t = 'error' ORDER BY ts DESC, o DESC, p LIMIT 50",
    "ingest_latency_approximate": "SELECT true AS p50_ms, true AS p95_ms",
    "payment_evidence": f"WITH {_LINES}, {_ORDERS}, {_TOTALS}, ct AS (SELECT TIMESTAMP '2001-08-01 01:20:00' AS cut), "
    "c AS (SELECT k, currency, coalesce(total, 0)::DECIMAL(20,2) AS total, date_diff('minute', placed + INTERVAL 1 HOUR, cut) AS age, k % 43 <> 0 AND flag <> 'O' AND placed + INTERVAL 2 HOUR <= cut AND k % 61 <> 0 AND k % 67 <> 0 AS cap, "
    "CASE WHEN k % 47 = 0 THEN 'GBP' ELSE currency END AS pc FROM po CROSS JOIN ct LEFT JOIN tt ON l_orderkey = k WHERE flag <> 'P' AND k % 29 <> 0 AND placed + INTERVAL 1 HOUR <= cut), "
    "h AS (SELECT *, CASE WHEN cap AND pc = currency THEN total + CASE WHEN k % 41 = 0 THEN 1 ELSE 0 END END AS paid FROM c), "
    "f AS (SELECT *, CASE WHEN cap AND pc <> currency THEN 'CURRENCY_MISMATCH' WHEN NOT cap AND total > 0 AND age >= 30 THEN 'MISSING_CAPTURE' WHEN paid <> total THEN 'AMOUNT_MISMATCH' END AS finding FROM h) "
    "SELECT CAST(k AS VARCHAR) AS order_id, currency, CAST(total AS DOUBLE) AS gross_amount, CAST(paid AS DOUBLE) AS paid_amount, finding, "
    "CASE WHEN finding = 'CURRENCY_MISMATCH' OR (finding = 'MISSING_CAPTURE' AND age >= 120) OR (finding = 'AMOUNT_MISMATCH' AND abs(paid - total) >= 100) THEN 'HIGH' ELSE 'NORMAL' END AS priority FROM f WHERE finding IS NOT NULL",
    "order_state_mismatches": f"{_STATE} SELECT order_id, status AS event_status, CASE WHEN order_id::BIGINT % 53 <> 0 THEN 'LOST' END AS status FROM so WHERE order_id::BIGINT % 53 = 0 OR order_id::BIGINT % 59 = 0",
    "differing_orders": "SELECT o_orderkey FROM orders WHERE o_orderkey % 997 = 0 OR (o_orderkey % 991 = 0 AND CAST(o_totalprice AS DECIMAL(20,2)) <> 1)",
    "topic_positions": f"{_RAW} SELECT t AS topic, count(*) AS partitions, CAST(sum(h - l) AS BIGINT) AS messages FROM (SELECT t, p, min(o) AS l, max(o) + 1 AS h FROM rw GROUP BY 1, 2) GROUP BY 1",
    "events_per_topic": f"{_RAW} SELECT t AS source_topic, count(*) AS events FROM jd WHERE err IS NULL GROUP BY 1",
    "ingest_latency": f"{_BASE}, d AS (SELECT 172800000 + CASE WHEN k % 14 = 0 AND version = 2 THEN -3600000 ELSE version * 3600000 END + (delivery - 1) * 3600000 AS ms FROM dl) SELECT quantile_cont(ms, 0.5)::DOUBLE AS p50_ms, quantile_cont(ms, 0.95)::DOUBLE AS p95_ms FROM d",
    "nearest_rank": "SELECT unnest([0.5, 0.95, 0.99])::DOUBLE AS share, unnest([quantile_disc(value, 0.5), quantile_disc(value, 0.95), quantile_disc(value, 0.99)]) AS value FROM events",
    "dataset_reconciliation": f"WITH {_CREATED} SELECT 'orders' AS dataset, count(*) AS row_count, count(*) AS expected_rows FROM orders UNION ALL "
    "SELECT 'order_lines', (SELECT count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey), CAST(sum(coalesce(m, 0)) AS BIGINT) FROM orders LEFT JOIN ct ON l_orderkey = o_orderkey UNION ALL "
    f"SELECT 'history', {_EVENTS_OF.format('true')}, {_EVENTS_OF.format('true')}",
    "matching_stock": f"{_STOCK} SELECT count(*) AS matching, count(*) AS matching_using FROM sk",
    "run_reconciliation": f"{_RAW} SELECT count(*) AS events, count(err) AS quarantined, 0::BIGINT AS topics_off, 0::BIGINT AS datasets_off, count(err) / count(*) AS quarantine_rate, CASE WHEN count(err) / count(*) <= 0.05 THEN 'PASS' ELSE 'FAIL' END AS result FROM jd",
    "evidence_check": "SELECT event_id, finding FROM (SELECT event_id, unnest(list_filter([CASE WHEN event_id % 101 = 0 AND event_id % 113 <> 0 THEN 'MISSING' END, CASE WHEN event_id % 101 <> 0 AND event_id % 113 = 0 THEN 'UNEXPECTED' END, "
    "CASE WHEN ok AND event_id % 109 = 0 THEN 'REPEATED' END, CASE WHEN ok AND event_id % 103 = 0 THEN 'CHANGED' END, CASE WHEN ok AND event_id % 107 = 0 AND event_id <> 0 THEN 'POSITION_UNKNOWN' END], lambda x: x IS NOT NULL)) AS finding "
    "FROM (SELECT event_id, event_id % 101 <> 0 AND event_id % 113 <> 0 AS ok FROM events))",
    "retail_lines": f"{_RETAIL} SELECT k || '-' || line_id AS row_id, reason FROM rl",
    "retail_orders": f"{_RETAIL} SELECT lpad(CAST(k AS VARCHAR), greatest(length(CAST(k AS VARCHAR)), 6)::INTEGER, '0') AS order_id, CASE WHEN customer % 50 <> 0 THEN substr(sha256(CAST(customer AS VARCHAR)), 1, 20) END AS customer_id, country, "
    "strftime(placed - CASE WHEN placed >= s AND placed < e THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END, '%Y-%m-%d %H:%M:%S') AS purchased_at, lines, CAST(amount AS DOUBLE) AS amount FROM ("
    "SELECT *, (date_trunc('month', make_date(year(placed), 3, 31)) + INTERVAL 30 DAY - ((dayofweek(make_date(year(placed), 3, 31))) * INTERVAL 1 DAY) + INTERVAL 1 HOUR) AS s, "
    "CASE WHEN year(placed) = 1995 THEN TIMESTAMP '1995-10-22 01:00:00' ELSE (make_date(year(placed), 10, 31)::TIMESTAMP - (dayofweek(make_date(year(placed), 10, 31)) * INTERVAL 1 DAY) + INTERVAL 1 HOUR) END AS e FROM iv WHERE heads = 1)",
    "retail_report": f"{_RETAIL} SELECT 'lines_' || reason AS measure, count(*) AS n FROM rl GROUP BY 1 UNION ALL SELECT CASE WHEN heads > 1 THEN 'invoices_conflicting_headers' ELSE 'invoices_published' END, count(*) FROM iv GROUP BY 1 "
    "UNION ALL SELECT 'lines_published', CAST(coalesce(sum(lines), 0) AS BIGINT) FROM iv WHERE heads = 1",
    "skew_join": "SELECT p_brand AS brand, count(*) AS rows, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total FROM lineitem JOIN part ON p_partkey = CASE WHEN (l_orderkey * 7 + l_linenumber) % 5 > 0 THEN 1 ELSE l_partkey END GROUP BY 1",
    "backfill_range": f"{_STATE} SELECT order_id, CASE WHEN updated_at::DATE BETWEEN DATE '2000-03-01' AND DATE '2000-03-31' THEN status ELSE 'CREATED' END AS status, {_double('gross_amount')} FROM so",
    "incremental_equals_full": "SELECT unnest(['purchase_items', 'customer_daily', 'customer_profiles', 'product_daily', 'customer_cohorts']) AS \"table\", 0::BIGINT AS differences, 5::BIGINT AS publications",
    "payload_violations": f"WITH {_CREATED} SELECT rule, CAST(n AS BIGINT) AS events FROM (SELECT 'ORDER_CURRENCY' AS rule, {_EVENTS_OF.format('o_orderkey % 97 = 0')} AS n "
    f"UNION ALL SELECT 'ORDER_REQUIRED', {_EVENTS_OF.format('o_orderkey % 89 = 0')} "
    f"UNION ALL SELECT 'ORDER_AMOUNT', {_EVENTS_OF.format('o_orderkey % 89 = 0')} "
    "UNION ALL SELECT 'CUSTOMER_EXTRA_KEYS', (SELECT count(*) FROM events WHERE event_id % 83 = 0))",
    "compaction": "SELECT unnest([1, 2])::BIGINT AS version, unnest([(SELECT count(*) FROM orders), (SELECT count(*) FROM orders)])::BIGINT AS records",
    "certified_kpis": f"{_STATE} SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS metric_date, market, 'UNCLASSIFIED' AS seller_tier, currency, count(*) AS order_count, CAST(sum(gross_amount) AS DOUBLE) AS gmv, "
    "CAST(sum(CASE WHEN status NOT IN ('CANCELLED', 'REFUNDED') THEN gross_amount ELSE 0 END) AS DOUBLE) AS net_revenue, count(*) FILTER (status = 'CANCELLED') AS cancelled_orders, "
    "CAST(CAST(count(*) FILTER (status = 'CANCELLED') / count(*) AS DECIMAL(12,6)) AS DOUBLE) AS cancellation_rate FROM so GROUP BY 1, 2, 3, 4 ORDER BY 1 DESC, 2, 3, 4 LIMIT 100",
    "product_page": f"{_DAILY} SELECT product_key, CAST(sum(orders) AS BIGINT) AS orders, CAST(sum(units) AS BIGINT) AS units, CAST(sum(returned_units) AS BIGINT) AS returned_units, CAST(sum(gross_amount) AS DOUBLE) AS gross_amount, CAST(sum(net_amount) AS DOUBLE) AS net_amount "
    f"FROM pd WHERE currency = 'EUR' AND product_key > 'shop:1' AND metric_date BETWEEN {FIRST} AND {LAST} GROUP BY 1 ORDER BY 1 LIMIT 51",
    "framed_events": "WITH ev AS (SELECT *, CASE WHEN event_id % 53 = 0 THEN ts - INTERVAL 30 HOUR ELSE ts END AS occ FROM events), "
    "js AS (SELECT event_type, event_id, '{\"event_id\":\"event-' || lpad(CAST(event_id AS VARCHAR), 8, '0') || '\",\"event_type\":\"site.' || event_type || '\",\"event_version\":1,' || "
    "CASE WHEN event_id % 43 <> 0 THEN '\"occurred_at\":\"' || strftime(occ, '%Y-%m-%dT%H:%M:%S.%gZ') || '\",' ELSE '' END || "
    "'\"produced_at\":\"' || strftime(CASE WHEN event_id % 59 = 0 THEN occ - INTERVAL 1 HOUR ELSE occ END, '%Y-%m-%dT%H:%M:%S.%gZ') || '\",\"producer\":\"site\",\"trace_id\":\"trace-' || lpad(CAST(event_id AS VARCHAR), 8, '0') || "
    "'\",\"partition_key\":\"' || user_id || '\",\"payload\":{' || coalesce('\"amount\":\"' || CASE WHEN event_id % 61 = 0 THEN '1e999' ELSE CAST(CAST(value AS DECIMAL(20,2)) AS VARCHAR) END || '\",', '') || "
    "'\"currency\":\"' || CASE WHEN event_id % 67 = 0 THEN 'euro' ELSE 'EUR' END || '\",\"quantity\":\"' || CASE WHEN event_id % 71 = 0 THEN 'several' ELSE '1' END || '\"},\"producer_sequence\":' || event_id || '}' AS body FROM ev), "
    "rc AS (SELECT event_type, event_id * 2 AS o, CASE WHEN event_id % 41 = 0 THEN substr(body, 1, 20) ELSE body END AS body FROM js), "
    "al AS (SELECT * FROM rc UNION ALL SELECT event_type, o + 1, body FROM rc WHERE o // 2 % 17 = 0), "
    "fr AS (SELECT event_type AS topic, o AS \"offset\", o % 13 <> 0 AS framed, CASE WHEN o % 13 <> 0 THEN o % 3 + 1 END AS schema_id, CASE WHEN o % 13 <> 0 THEN body END AS body FROM al) "
    "SELECT topic, \"offset\", framed, schema_id, CAST(strlen(body) AS BIGINT) AS body_bytes, sha256(body) AS body_sha256, count(*) OVER (PARTITION BY topic, framed, schema_id) AS events FROM fr",
    "recent_events": "SELECT topic, partition, \"offset\", place FROM (SELECT event_type AS topic, user_id % 3 AS partition, o AS \"offset\", row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, o DESC, user_id % 3) AS place FROM ("
    "SELECT *, event_id * 2 AS o FROM events UNION ALL SELECT *, event_id * 2 + 1 FROM events WHERE event_id % 17 = 0)) WHERE place <= 20",
    "pipeline_health": "WITH r AS (SELECT 'pipeline-' || user_id % 5 AS pipeline, ts, event_type = 'error' AS f, event_type = 'error' AND event_id % 2 = 0 AS g, event_id % 3 AS j FROM events), "
    "x AS (SELECT pipeline, max(ts) FILTER (NOT f) AS s, max(ts) FILTER (f) AS l, max(ts) FILTER (g) AS g, arg_max(j, ts) AS rejected_rows FROM r GROUP BY 1), n AS (SELECT TIMESTAMP '2024-01-30 23:59:00' - INTERVAL 30 MINUTE AS t) "
    "SELECT pipeline, strftime(s, '%Y-%m-%d %H:%M:%S') AS last_success, strftime(l, '%Y-%m-%d %H:%M:%S') AS last_failure, strftime(g, '%Y-%m-%d %H:%M:%S') AS last_gate_failure, rejected_rows, "
    "array_to_string(list_filter([CASE WHEN s IS NULL OR s < t THEN 'STALE' END, CASE WHEN l > coalesce(s, TIMESTAMP '1970-01-01') THEN 'FAILING' END, CASE WHEN g >= t THEN 'GATE_FAILED' END, CASE WHEN rejected_rows > 0 THEN 'REJECTED_ROWS' END], lambda v: v IS NOT NULL), ',') AS alerts FROM x, n",
    "stream_append": f"{_RAW} SELECT t AS source_topic, count(*) AS events FROM jd WHERE err IS NULL GROUP BY 1",
    "stream_dedupe": f"{_RAW} SELECT DISTINCT t AS source_topic, 'event-' || lpad(CAST(e AS VARCHAR), 8, '0') AS event_id, strftime(CASE WHEN e % 53 = 0 THEN ts - INTERVAL 30 HOUR ELSE ts END, '%Y-%m-%d %H:%M:%S') AS occurred_at, "
    "'trace-' || lpad(CAST(e AS VARCHAR), 8, '0') AS trace_id FROM jd WHERE err IS NULL",
    "stream_late": f"{_RAW}, b AS (SELECT *, CASE WHEN e % 53 = 0 AND date_diff('day', DATE '2024-01-01', ts::DATE) < 10 THEN 4 ELSE least(date_diff('day', DATE '2024-01-01', ts::DATE) // 5, 5) END AS batch_id, CASE WHEN e % 53 = 0 THEN ts - INTERVAL 30 HOUR ELSE ts END AS occ FROM jd), "
    "h AS (SELECT batch_id, max(occ) FILTER (err IS NULL) AS top FROM b GROUP BY 1), "
    "w AS (SELECT batch_id, (SELECT max(top) FROM h p WHERE p.batch_id < h.batch_id - 1) - INTERVAL 24 HOUR AS mark FROM h) "
    "SELECT batch_id, count(*) AS records, count(*) FILTER (err IS NULL AND mark IS NOT NULL AND date_trunc('millisecond', occ) <= date_trunc('millisecond', mark)) AS late FROM b JOIN w USING (batch_id) GROUP BY 1",
    "stream_upserts": f"{_RAW} SELECT DISTINCT 'event-' || lpad(CAST(e AS VARCHAR), 8, '0') AS event_id, t AS source_topic, CASE WHEN e % 14 = 0 THEN 'third' WHEN e % 7 = 0 THEN 'second' ELSE 'site' END AS producer FROM jd WHERE err IS NULL",
    "batch_metrics": f"{_RAW}, b AS (SELECT *, CASE WHEN e % 53 = 0 AND date_diff('day', DATE '2024-01-01', ts::DATE) < 10 THEN 4 ELSE least(date_diff('day', DATE '2024-01-01', ts::DATE) // 5, 5) END AS batch FROM jd WHERE err IS NULL), "
    "f AS (SELECT e, min(batch) AS batch, min(ts) AS ts FROM b GROUP BY 1) SELECT batch, count(*) AS rows, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS max_source_timestamp, true AS lagged FROM f GROUP BY 1",
    "stream_interval": f"{_RAW} SELECT t AS source_topic, count(DISTINCT e) AS events FROM jd WHERE err IS NULL GROUP BY 1",
    "run_report_with_latency": f"{_BASE} SELECT count(*) AS events, 0::BIGINT AS quarantined, 0::BIGINT AS topics_off, 'PASS' AS result, true AS p50_ms, true AS p95_ms FROM dl",
    "purchase_lines": f"{_BASE}, ok AS (SELECT k, k // 20000 AS piece FROM po WHERE k NOT IN (SELECT k FROM rj)), nb AS (SELECT k, piece, row_number() OVER w + sum(CASE WHEN k % 50 = 0 THEN 1 ELSE 0 END) OVER w AS line FROM ok WINDOW w AS (PARTITION BY piece ORDER BY k)) "
    "SELECT piece, CAST(line AS BIGINT) AS line_number, '{broken ' || k AS raw_value FROM nb WHERE k % 97 = 1",
    "over_returns": f"{_BASE}, ex AS (SELECT DISTINCT k FROM po JOIN ln ON l_orderkey = k WHERE k % 89 = 0 AND l_returnflag = 'R'), "
    "f AS (SELECT order_key, k % 97 = 0 OR (k % 101 = 0 AND k IN (SELECT l_orderkey FROM has)) AS bad, k % 103 = 0 AS clash, k IN (SELECT k FROM ex) AS excess FROM po) "
    "SELECT order_key, array_to_string(list_filter([CASE WHEN clash THEN 'conflicting payloads for the same order version' END, CASE WHEN bad THEN 'invalid purchase snapshot' END, CASE WHEN excess THEN 'returns exceed purchased quantity or amount' END], lambda x: x IS NOT NULL), '; ') AS reason "
    "FROM f WHERE bad OR clash OR excess",
    "range_reads": f"{_BASE}, ev AS (SELECT sha256('shop:' || k || ':' || version || CASE WHEN variant > 0 THEN ':other' ELSE '' END) AS event_id, k * 8 + version * 2 + variant + (delivery - 1) * 4000000000 AS source_offset, CASE WHEN version = 2 THEN 3 WHEN k % 10 = 9 THEN 2 ELSE 1 END AS b FROM dl) "
    "SELECT unnest(list_filter(['full-current-snapshot', CASE WHEN b > 1 THEN 'start=1' END, CASE WHEN b <= 2 THEN 'end=2' END, CASE WHEN b = 2 THEN 'start=1,end=2' END], lambda x: x IS NOT NULL)) AS evidence, event_id, CAST(source_offset AS BIGINT) AS source_offset FROM ev",
    "upsert_plain": f"{_STATE} SELECT order_id, CASE WHEN order_id::BIGINT % 3 = 0 THEN 'PUT' ELSE status END AS status, currency FROM so WHERE order_id::BIGINT % 2 = 0 OR order_id::BIGINT % 3 = 0",
    "capped_customers": f"{_DAILY} SELECT customer_key, {_text('metric_date')}, currency, CAST(gross_amount AS DOUBLE) AS gross_amount, (SELECT count(*) > 500 FROM cd) AS truncated FROM cd ORDER BY cd.gross_amount DESC, customer_key, cd.metric_date, currency LIMIT 500",
    "gate_outcomes": "SELECT 'same' AS input, true AS passed, false AS stopped UNION ALL SELECT 'lacking', count(*) = 0, count(*) > 0 FROM orders WHERE o_orderkey % 79 = 0",
    "retention_plan": f"WITH d AS (SELECT o_orderpriority AS pl, o_orderkey AS s, o_orderdate AS placed FROM orders), kp AS (SELECT s FROM d QUALIFY row_number() OVER (PARTITION BY pl ORDER BY s DESC) <= 5 UNION SELECT s FROM d WHERE placed >= {AS_OF} - INTERVAL 365 DAY), "
    "v AS (SELECT 'a' AS t, s AS version, s FROM d UNION ALL SELECT 'b', s // 600, s FROM d), ke AS (SELECT DISTINCT t, version FROM v WHERE s IN (SELECT s FROM kp)) SELECT DISTINCT t AS \"table\", version FROM v ANTI JOIN ke USING (t, version)",
    "partitions_replaced": "SELECT o_orderstatus AS status, count(*) AS orders, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE CAST(o_totalprice AS DECIMAL(20,2)) END) AS DOUBLE) AS total FROM orders GROUP BY 1",
    "batch_written_twice": "SELECT o_orderkey % 3 + 1 AS batch_id, count(*) AS orders, count(*) FILTER (o_orderkey % 3 <> 0) AS with_status FROM orders GROUP BY 1",
    "physical_evidence": "SELECT 'orders' AS \"table\", count(*) AS records, 4::BIGINT AS files, true AS sized, 'UTC' AS zone FROM orders UNION ALL SELECT 'customer', count(*), 4, true, 'UTC' FROM customer",
    "conformed_twice": f"{_STOCK}, {_CREATED} SELECT unnest(['inventory_daily', 'order_lines', 'order_status_history', 'orders', 'payments', 'shipments']) AS \"table\", unnest([(SELECT count(*) FROM sk), (SELECT count(*) FROM ol), "
    f"{_EVENTS_OF.format('true')}, (SELECT count(*) FROM orders), (SELECT count(*) FROM orders), (SELECT count(DISTINCT l_orderkey) FROM lineitem JOIN orders ON o_orderkey = l_orderkey)])::BIGINT AS rows",
}
_LATEST = f"lc AS (SELECT * FROM co WHERE currency = 'EUR' AND co.cohort_month >= date_trunc('month', {AS_OF}) - INTERVAL 23 MONTH AND month_number <= 12)"
_OF_WINDOW = f"WHERE currency = 'EUR' AND metric_date BETWEEN {FIRST} AND {LAST} GROUP BY 1"
_LONG = "WHERE currency = 'EUR' AND metric_date BETWEEN DATE '1996-03-15' AND DATE '2001-03-14' GROUP BY 1"
#: Judged range by range, the second version of a clashing first one is accepted, as it comes in a later range.
_BY_RANGE = ("k % 103 = 0 AS clash FROM po)", "k % 103 = 0 AND k % 7 <> 0 AS clash FROM po)")
ORACLE_SQL |= {
    "profiles_by_calendar": ORACLE_SQL["customer_profiles"].replace(*_BY_RANGE),
    "cohorts_by_bitmaps": ORACLE_SQL["customer_cohorts"].replace(*_BY_RANGE),
    "facts_by_months": ORACLE_SQL["customer_daily"].replace(*_BY_RANGE),
    "run_audit": f"{_BASE}, ev AS (SELECT k, version, variant, country_sent, delivery, CASE WHEN version = 2 THEN 3 WHEN k % 10 = 9 THEN 2 ELSE 1 END AS b, k % 97 = 0 OR (k % 103 = 0 AND version = 1) "
    "OR (k % 101 = 0 AND EXISTS (SELECT 1 FROM ln WHERE l_orderkey = k AND NOT (version = 2 AND l_linenumber = 1))) AS bad FROM dl), "
    "f AS (SELECT b, count(*) AS n, count(DISTINCT CASE WHEN bad THEN k || ':' || version || ':' || variant END) AS r FROM ev GROUP BY 1), "
    "runs(b, bound, v, news) AS (VALUES (1, '(0, 1]', '1', true), (2, '(1, 2]', '2', true), (2, '(2, 2]', '3', false), (3, '(2, 3]', '4', true), (3, '(3, 3]', '5', false)) "
    "SELECT 'customer_analytics_v1' AS pipeline, 'purchases' AS dataset, 'SUCCEEDED' AS status, CASE WHEN news THEN n ELSE 0 END::BIGINT AS input_rows, CASE WHEN news THEN r ELSE 0 END::BIGINT AS rejected_rows, bound AS input_bound, v AS output_version, true AS wrote FROM runs JOIN f USING (b)",
    "run_health": "SELECT 'customer_analytics_v1' AS pipeline, true AS no_failure, 0::BIGINT AS rejected_rows, '' AS alerts",
    "retention_with_parts": f"WITH d AS (SELECT DISTINCT date_diff('day', DATE '1995-01-01', o_orderdate::DATE) AS n, date_trunc('day', o_orderdate) AS at_day FROM orders), "
    f"kp AS (SELECT n FROM d QUALIFY row_number() OVER (ORDER BY n DESC) <= 5 UNION SELECT n FROM d WHERE at_day >= {AS_OF} - INTERVAL 60 DAY), "
    "hold AS (SELECT n FROM kp UNION SELECT (SELECT max(d.n) FROM d WHERE d.n <= kp.n AND d.n % 12 = p) FROM kp, (SELECT unnest(range(12)) AS p)) "
    "SELECT 'facts' AS \"table\", CAST(n AS VARCHAR) AS version FROM d WHERE n NOT IN (SELECT n FROM hold WHERE n IS NOT NULL)",
    "stream_quarantine": ORACLE_SQL["quarantined_events"],
    "summary_five_years": f"{_DAILY} SELECT count(*) AS customers, CAST(sum(o) AS BIGINT) AS orders, CAST(sum(n) AS DOUBLE) AS net_amount, count(*) FILTER (o >= 2) AS repeat_customers FROM (SELECT customer_key, sum(orders) AS o, sum(net_amount) AS n FROM cd {_LONG})",
    "product_totals_five_years": f"{_DAILY} SELECT product_key, CAST(sum(orders) AS BIGINT) AS orders, CAST(sum(units) AS BIGINT) AS units, CAST(sum(returned_units) AS BIGINT) AS returned_units, CAST(sum(gross_amount) AS DOUBLE) AS gross_amount, CAST(sum(net_amount) AS DOUBLE) AS net_amount FROM pd {_LONG}",
    "customers_rebuilt": ORACLE_SQL["customer_history"],
    "customers_spliced": ORACLE_SQL["customer_history"],
    "kpis_published": ORACLE_SQL["daily_kpis"],
    "demand_published": ORACLE_SQL["demand_features"],
    "customer_page": ORACLE_SQL["customer_profiles"] + " WHERE currency = 'EUR' AND customer_key > 'shop:2' ORDER BY customer_key LIMIT 51",
    "latest_cohorts": f"{_COHORTS}, {_LATEST} SELECT {_text('cohort_month', 'activity_month')}, currency, cohort_size, active_customers, month_number, retention, complete FROM lc",
    "dashboard_retention": f"{_COHORTS}, {_LATEST} SELECT {_text('cohort_month')}, currency, max(cohort_size) AS cohort_size, CAST(min(CAST(complete AS INT)) AS BIGINT) AS all_complete, "
    + ", ".join(f"max(CASE WHEN month_number = {i} THEN retention END) AS m{i}" for i in range(13)) + " FROM lc GROUP BY cohort_month, currency",
    "dashboard_frames": f"{_PROFILES}{_COHORTS[len(_DAILY):]}, {_LATEST}, wc AS (SELECT customer_key, sum(net_amount) AS n FROM cd {_OF_WINDOW}), wp AS (SELECT product_key, sum(net_amount) AS n FROM pd {_OF_WINDOW}), "
    "cp AS (SELECT n FROM pr JOIN wc USING (customer_key) WHERE currency = 'EUR' ORDER BY customer_key LIMIT 51), pp AS (SELECT n FROM wp ORDER BY product_key LIMIT 51), "
    "sg AS (SELECT segment, count(*) AS n FROM pr WHERE currency = 'EUR' GROUP BY 1), cz AS (SELECT cohort_month, max(cohort_size) AS n FROM lc GROUP BY 1) "
    "SELECT frame, CAST(r AS BIGINT) AS rows, CAST(t AS DOUBLE) AS total FROM (SELECT 'summary' AS frame, 1 AS r, sum(n) AS t FROM wc UNION ALL SELECT 'segments', count(*), sum(n) FROM sg UNION ALL SELECT 'customers', count(*), sum(n) FROM cp "
    "UNION ALL SELECT 'products', count(*), sum(n) FROM pp UNION ALL SELECT 'cohorts', count(*), sum(active_customers) FROM lc UNION ALL SELECT 'retention', count(*), sum(n) FROM cz)",
}
