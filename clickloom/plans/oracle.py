"""The registered queries in plain SQL over the same tables, written independently of the
operators: carts and sessions use ordinary windows, shares use subqueries."""

from __future__ import annotations

# Written out here, so that a wrong mapping in the package shows: group, column and whether only purchases count.
DIMENSIONS = {
    "channel": ("marketing", "channel", False), "source": ("marketing", "source", False),
    "medium": ("marketing", "medium", False), "campaign": ("marketing", "campaign_name", False),
    "segment": ("customer", "segment", False), "loyalty_tier": ("customer", "loyalty_tier", False),
    "membership": ("customer", "is_member", False), "customer_country": ("customer", "country", False),
    "product": ("product", "product_id", False), "category": ("product", "category", False),
    "brand": ("product", "brand", False), "device_type": ("ops", "device_type", False),
    "os": ("ops", "os", False), "event_source": ("ops", "event_source", False),
    "country": ("ops", "country", False), "city": ("ops", "city", False),
    "order_status": ("ops", "status", True), "payment_method": ("ops", "payment_method", True),
    "payment_provider": ("ops", "payment_provider", True),
}
FUNNEL_STAGES = ("product_view", "click", "add_to_cart", "update_cart", "remove_from_cart", "begin_checkout",
                 "checkout_progress", "purchase")

EVENTS = """
base AS (
  SELECT event_id AS seq, ts AS event_time, user_id AS uid, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE WHEN event_type = 'view' THEN 'product_view'
              WHEN event_type = 'click' THEN CASE WHEN value >= 60 THEN 'add_to_cart' ELSE 'click' END
              WHEN event_type = 'signup' THEN CASE WHEN value >= 60 THEN 'checkout_progress' ELSE 'begin_checkout' END
              WHEN event_type = 'error' THEN CASE WHEN value >= 60 THEN 'remove_from_cart' ELSE 'update_cart' END
              WHEN event_type = 'purchase' THEN 'purchase' END AS event_name
  FROM events
),
ev AS (
  SELECT *, CAST(uid AS VARCHAR) AS user_id,
         CAST(uid AS VARCHAR) || '-' || strftime(event_time, '%Y-%m-%d') AS session_id,
         strftime(event_time, '%Y-%m-%d') AS day,
         'SKU' || lpad(CAST(k + 1 AS VARCHAR), 5, '0') AS sku,
         CASE WHEN event_name IN ('begin_checkout', 'checkout_progress', 'purchase') AND seq % 2 = 0 THEN NULL
              ELSE 'SKU' || lpad(CAST(k + 1 AS VARCHAR), 5, '0') END AS product_id,
         CASE WHEN seq % 3 <> 0 THEN 1 + k % 5 END AS quantity,
         CASE WHEN seq % 4 <> 0 THEN value END AS price,
         CASE WHEN value >= 10 THEN value END AS revenue,
         CASE WHEN seq % 13 <> 0 THEN CASE WHEN seq % 2 = 0 THEN 'web' ELSE 'app' END END AS event_source
  FROM base
)"""

SILVER = EVENTS + """,
silver AS (
  SELECT ev.*, p_type AS category, p_brand AS brand, p_retailprice AS product_price,
         CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS status,
         o_orderpriority AS payment_method,
         CASE WHEN o_orderkey IS NOT NULL AND seq % 2 = 0 THEN 'P' || CAST(k % 3 AS VARCHAR) END AS payment_provider,
         o_totalprice AS order_total,
         CASE WHEN uid % 9 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS customer_id,
         CASE WHEN uid % 9 <> 0 THEN c_mktsegment END AS segment,
         CASE WHEN uid % 9 <> 0 THEN CASE WHEN c_acctbal < 0 THEN 'bronze' WHEN c_acctbal < 5000 THEN 'silver'
                                          WHEN c_acctbal IS NOT NULL THEN 'gold' END END AS loyalty_tier,
         CASE WHEN uid % 7 <> 0 THEN c_acctbal > 0 END AS is_member,
         n_name AS country,
         CASE WHEN uid % 5 <> 0 THEN 'City' || CAST(uid % 20 AS VARCHAR) END AS city,
         CASE WHEN uid % 10 <> 0 THEN 'ch' || CAST(uid % 4 AS VARCHAR) END AS channel,
         CASE WHEN uid % 10 <> 0 THEN 'src' || CAST(uid % 5 AS VARCHAR) END AS source,
         CASE WHEN uid % 10 <> 0 THEN 'med' || CAST(uid % 3 AS VARCHAR) END AS medium,
         CASE WHEN uid % 10 <> 0 THEN 'camp' || CAST(uid % 6 AS VARCHAR) END AS campaign_name,
         CASE WHEN uid % 11 <> 0 THEN CASE uid % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END END AS device_type,
         CASE WHEN uid % 11 <> 0 THEN 'os' || CAST(uid % 4 AS VARCHAR) END AS os
  FROM ev
  LEFT JOIN part ON p_partkey = k + 1
  LEFT JOIN orders ON o_orderkey = seq AND event_name = 'purchase'
  LEFT JOIN customer ON c_custkey = uid
  LEFT JOIN nation ON n_nationkey = c_nationkey
)"""

UNITS = "COALESCE(quantity, 1)"
AMOUNT = "COALESCE(revenue, order_total, 0.0)"
SALES = f"{UNITS} * COALESCE(price, product_price, 0.0)"
PURCHASE = "event_name = 'purchase'"

VISITS = """COUNT(DISTINCT user_id) AS users, COUNT(DISTINCT session_id) AS sessions"""
ORDERS = f"COUNT(DISTINCT CASE WHEN {PURCHASE} THEN order_id END) AS orders"
BUYERS = f"COUNT(DISTINCT CASE WHEN {PURCHASE} THEN user_id END) AS buyers"


def money(revenue: str = "revenue_usd") -> str:
    return f"""CAST(SUM(CASE WHEN {PURCHASE} THEN {UNITS} ELSE 0 END) AS BIGINT) AS units_sold,
       ROUND(SUM(CASE WHEN {PURCHASE} THEN {AMOUNT} ELSE 0.0 END), 2) AS {revenue},
       ROUND(SUM(CASE WHEN {PURCHASE} THEN {SALES} ELSE 0.0 END), 2) AS total_sales_usd"""


def count_of(name: str, alias: str) -> str:
    return f"CAST(SUM(CASE WHEN event_name = '{name}' THEN 1 ELSE 0 END) AS BIGINT) AS {alias}"


STAGE_COUNTS = ", ".join(count_of(s, s) for s in FUNNEL_STAGES)
STAGE_ROWS = ", ".join(f"({i}, '{s}')" for i, s in enumerate(FUNNEL_STAGES, 1))


def dimension_sql(name: str) -> str:
    if name == "membership":
        return "CASE WHEN is_member = true THEN 'member' ELSE 'non_member' END"
    if name == "product":
        return "COALESCE(product_id, sku, 'unknown')"
    column = DIMENSIONS[name][1]
    return f"COALESCE({column}, 'unknown')"


def dimension_query(name: str) -> str:
    only = f"WHERE {PURCHASE}" if DIMENSIONS[name][2] else ""
    return f"""WITH {SILVER}
SELECT {dimension_sql(name)} AS dimension, COUNT(*) AS events, {VISITS}, {ORDERS}, {BUYERS}, {money()}
FROM silver {only} GROUP BY 1"""


def product_query(name: str) -> str:
    dim = dimension_sql(name)
    return f"""WITH {SILVER}
SELECT {dim} AS dimension, {count_of('product_view', 'product_views')}, {count_of('add_to_cart', 'add_to_cart')},
       {count_of('begin_checkout', 'begin_checkout')}, {count_of('purchase', 'purchase_events')},
       {ORDERS}, {BUYERS}, {money()}
FROM silver WHERE {dim} <> 'unknown' GROUP BY 1"""


def page_query(name: str) -> str:
    report = product_query(name) if DIMENSIONS[name][0] == "product" else dimension_query(name)
    share = per("orders", "SUM(orders) OVER ()")
    return f"SELECT *, {share} AS share, round_even({share} * 100.0, 2) AS share_pct FROM ({report})"


def bars_query(name: str, metric: str, n: int = 15) -> str:
    report = product_query(name) if DIMENSIONS[name][0] == "product" else dimension_query(name)
    # The key column of money metrics is rounded, as in the report itself.
    return f"""SELECT dimension, {metric},
       ROUND({metric} / CAST((SELECT SUM({metric}) FROM ({report})) AS DOUBLE), 6) AS share
FROM ({report}) ORDER BY {metric} DESC, dimension LIMIT {n}"""


EVENT_MIX = f"""WITH {SILVER}
SELECT event_name, COUNT(*) AS events, {VISITS}, {ORDERS}, {money()} FROM silver GROUP BY event_name"""

SERIES = f"""WITH {SILVER}
SELECT day AS time_bucket, COUNT(*) AS total_events, {VISITS}, {count_of('product_view', 'product_views')},
       {count_of('add_to_cart', 'add_to_cart')}, {count_of('begin_checkout', 'begin_checkout')},
       {count_of('purchase', 'purchase_events')}, {ORDERS}, {money()}
FROM silver GROUP BY day"""

STAGES = f"WITH {EVENTS} SELECT {STAGE_COUNTS} FROM ev"

COUNTS = EVENTS + """,
counts AS (
  SELECT product_id, event_name, COUNT(*) AS n FROM ev WHERE product_id IS NOT NULL GROUP BY 1, 2
),
per_event AS (
  SELECT event_name, CAST(SUM(n) AS BIGINT) AS n, COUNT(DISTINCT product_id) AS products FROM counts GROUP BY 1
),
per_product AS (
  SELECT product_id, CAST(SUM(n) AS BIGINT) AS n, COUNT(DISTINCT event_name) AS kinds FROM counts GROUP BY 1
),
stages AS (
  SELECT pos, s.event_name, COALESCE(n, 0) AS n
  FROM (VALUES """ + STAGE_ROWS + """) AS s(pos, event_name) LEFT JOIN per_event e ON e.event_name = s.event_name
)"""


def per(numerator: str, denominator: str) -> str:
    return f"COALESCE(CAST({numerator} AS DOUBLE) / NULLIF({denominator}, 0), 0.0)"


def stage(name: str) -> str:
    return f"(SELECT n FROM stages WHERE event_name = '{name}')"


def pareto_query(table: str, key: str, n: int = 15) -> str:
    return f"""WITH {COUNTS},
largest AS (SELECT {key}, n FROM {table} ORDER BY n DESC, {key} LIMIT {n})
SELECT {key}, n AS count,
       CAST(SUM(n) OVER (ORDER BY n DESC, {key} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative,
       CAST(SUM(n) OVER (ORDER BY n DESC, {key} ROWS UNBOUNDED PRECEDING) AS DOUBLE)
         / (SELECT SUM(n) FROM largest) * 100.0 AS cumulative_pct
FROM largest"""


BUSIEST = """busiest AS (SELECT product_id FROM per_product ORDER BY n DESC, product_id LIMIT 1),
chosen AS (SELECT event_name, n FROM counts WHERE product_id = (SELECT product_id FROM busiest))"""

BOTH = COUNTS + """,
batch AS (SELECT event_name, COUNT(*) AS b FROM ev GROUP BY 1),
both_layers AS (
  SELECT COALESCE(batch.event_name, e.event_name) AS event_name, COALESCE(b, 0) AS b, COALESCE(n, 0) AS s,
         COALESCE(CAST(b AS DOUBLE) / (SELECT SUM(b) FROM batch), 0.0) AS bs,
         COALESCE(CAST(n AS DOUBLE) / (SELECT SUM(n) FROM per_event), 0.0) AS ss
  FROM batch FULL JOIN per_event e ON e.event_name = batch.event_name
)"""

# Messages: which ones are broken follows from the event number.
BROKEN = """COALESCE(nullif(CASE WHEN seq % 23 = 0 THEN 'unparsable' ELSE concat_ws(',',
  CASE WHEN seq % 29 = 0 THEN 'bad_time' END,
  CASE WHEN name IS NULL THEN 'null_event_name' END,
  CASE WHEN name = 'wishlist' THEN 'unknown_event_name' END,
  CASE WHEN name IN ('add_to_cart', 'update_cart', 'remove_from_cart') AND quantity IS NULL THEN 'missing:quantity' END,
  CASE WHEN name IN ('product_view', 'click', 'add_to_cart', 'update_cart', 'remove_from_cart') AND price IS NULL THEN 'missing:price' END,
  CASE WHEN name IN ('begin_checkout', 'checkout_progress', 'purchase') AND seq % 43 = 0 THEN 'missing:checkout_id' END,
  CASE WHEN name = 'purchase' AND seq % 47 = 0 THEN 'missing:order_id' END,
  CASE WHEN name IN ('add_to_cart', 'update_cart', 'remove_from_cart', 'begin_checkout', 'checkout_progress', 'purchase')
        AND seq % 41 = 0 THEN 'missing:cart_items_qty' END,
  CASE WHEN name = 'purchase' AND revenue IS NULL THEN 'missing:revenue' END,
  CASE WHEN name = 'purchase' AND seq % 5 = 0 THEN 'missing:items' END) END, ''), '') AS reasons"""

MESSAGES = EVENTS + f""",
named AS (
  SELECT *, CASE WHEN seq % 31 = 0 THEN NULL WHEN seq % 37 = 0 THEN 'wishlist' ELSE event_name END AS name FROM ev
),
checked AS (SELECT *, {BROKEN} FROM named)"""

# Carts: an event's effect on its product is the quantity after it less the one before.
CARTS = EVENTS + """,
log AS (
  SELECT 'C' || user_id AS cart_id, session_id, event_time, 'E' || lpad(CAST(seq AS VARCHAR), 18, '0') AS event_id,
         event_name, event_name IN ('add_to_cart', 'update_cart', 'remove_from_cart') AS touches,
         event_name IN ('update_cart', 'remove_from_cart') AS resets,
         k % 5 AS slot, 1 + seq % 4 AS quantity, 10.0 + 2.25 * (k % 5) AS price
  FROM ev
),
epochs AS (
  SELECT *, COALESCE(SUM(CASE WHEN event_name = 'purchase' THEN 1 ELSE 0 END) OVER (
           PARTITION BY cart_id ORDER BY event_time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS epoch
  FROM log
),
segments AS (
  SELECT *, SUM(CASE WHEN resets THEN 1 ELSE 0 END) OVER (
           PARTITION BY cart_id, epoch, slot, touches ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS g
  FROM epochs
),
held AS (
  SELECT *, CASE WHEN touches THEN SUM(CASE WHEN touches AND event_name <> 'remove_from_cart' THEN quantity ELSE 0 END) OVER (
           PARTITION BY cart_id, epoch, slot, touches, g ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) ELSE 0 END AS after
  FROM segments
),
deltas AS (
  SELECT *, CASE WHEN touches THEN after - COALESCE(LAG(after) OVER (
           PARTITION BY cart_id, epoch, slot, touches ORDER BY event_time, event_id), 0) ELSE 0 END AS delta
  FROM held
),
replayed AS (
  SELECT *, CAST(SUM(delta) OVER w AS BIGINT) AS qty, ROUND(SUM(delta * price) OVER w, 2) AS worth
  FROM deltas
  WINDOW w AS (PARTITION BY cart_id, epoch ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING)
)"""

ORDER_EVENTS = """
line AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS event_id,
         CAST(l_orderkey AS VARCHAR) AS order_id, l_shipdate, l_linenumber, l_partkey, l_quantity,
         unnest(range(0, l_linenumber % 3 + 1)) AS i, row_number() OVER () AS rid
  FROM lineitem
),
items AS (
  SELECT rid, event_id, order_id, l_shipdate, l_linenumber, i AS line,
         'SKU' || CAST(l_partkey + i AS VARCHAR) AS product_id, 'Producto ' || CAST(l_partkey + i AS VARCHAR) AS name,
         'Cat' || CAST((l_partkey + i) % 7 AS VARCHAR) AS category,
         5.0 + (l_partkey + i) % 400 * 0.25 AS price, CAST(l_quantity AS INTEGER) + i AS quantity
  FROM line
)"""


# Arrivals in three parts of time, every seventh message one part later; rows whose hour was closed by then.
LATE = MESSAGES + """,
span AS (SELECT MIN(CAST(floor(epoch(event_time)) AS BIGINT)) AS lo, MAX(CAST(floor(epoch(event_time)) AS BIGINT)) AS hi FROM ev),
sent AS (
  SELECT named.*, date_trunc('second', event_time) AS sent_at,
         (CAST(floor(epoch(event_time)) AS BIGINT) - lo) // ((hi - lo) // 3 + 1) + CASE WHEN seq % 7 = 0 THEN 1 ELSE 0 END AS part
  FROM named, span WHERE seq % 23 <> 0 AND seq % 29 <> 0 AND product_id IS NOT NULL
),
newest AS (SELECT part, MAX(sent_at) AS last_at FROM sent GROUP BY 1),
passed AS (SELECT part, MAX(last_at) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 10 MINUTE AS mark
           FROM newest),
late AS (SELECT sent.* FROM sent JOIN passed USING (part) WHERE date_trunc('hour', sent_at) + INTERVAL 1 HOUR <= mark)"""


def all_sql() -> dict[str, str]:
    sql = {
        "overview": f"""WITH {SILVER}
SELECT COUNT(*) AS total_events, {VISITS}, COUNT(DISTINCT customer_id) AS customers, {STAGE_COUNTS},
       COUNT(DISTINCT CASE WHEN {PURCHASE} THEN order_id END) AS distinct_orders, {BUYERS},
       {money('realized_revenue_usd')},
       ROUND(AVG(CASE WHEN {PURCHASE} THEN {AMOUNT} END), 4) AS avg_order_value_usd
FROM silver""",
        "overview_ratios": f"""SELECT {per('add_to_cart', 'product_view')} AS view_to_cart,
       {per('begin_checkout', 'add_to_cart')} AS cart_to_checkout,
       {per('purchase', 'begin_checkout')} AS checkout_to_purchase FROM ({STAGES})""",
        "overview_funnel": f"""WITH {EVENTS}
SELECT pos, s.event_name, COUNT(ev.event_name) AS count
FROM (VALUES {STAGE_ROWS}) AS s(pos, event_name) LEFT JOIN ev ON ev.event_name = s.event_name GROUP BY 1, 2""",
        "event_mix": EVENT_MIX,
        "event_mix_page": f"""SELECT *, CAST(events AS DOUBLE) / SUM(events) OVER () AS share,
       round_even(CAST(events AS DOUBLE) / SUM(events) OVER () * 100.0, 2) AS share_pct FROM ({EVENT_MIX})""",
        "daily_series": SERIES,
        "series_totals": f"""SELECT COUNT(*) AS days, ROUND(SUM(revenue_usd), 2) AS revenue_usd,
       ROUND(SUM(total_sales_usd), 2) AS total_sales_usd, CAST(SUM(units_sold) AS BIGINT) AS units_sold,
       CAST(SUM(orders) AS BIGINT) AS orders, ROUND(SUM(revenue_usd) / COUNT(*), 2) AS avg_daily_revenue_usd,
       ROUND(SUM(total_sales_usd) / COUNT(*), 2) AS avg_daily_sales_usd FROM ({SERIES})""",
        "product_totals": f"""SELECT CAST(SUM(product_views) AS BIGINT) AS product_views,
       CAST(SUM(add_to_cart) AS BIGINT) AS add_to_cart, CAST(SUM(orders) AS BIGINT) AS orders,
       CAST(SUM(units_sold) AS BIGINT) AS units_sold, ROUND(SUM(revenue_usd), 2) AS revenue_usd,
       ROUND(SUM(total_sales_usd), 2) AS total_sales_usd FROM ({product_query('category')})""",
        "multi_dimension": f"WITH {SILVER} " + " UNION ALL ".join(
            f"SELECT '{d}' AS dimension_name, {dimension_sql(d)} AS dimension, COUNT(*) AS events, {money()} "
            f"FROM silver GROUP BY 2"
            for d in ("channel", "device_type", "event_source", "category", "brand")),
        "heatmap_day_event": f"""WITH {EVENTS}
SELECT day AS time_bucket, event_name, COUNT(*) AS cnt FROM ev GROUP BY 1, 2""",
        "heatmap_top_events": f"""WITH {EVENTS}
SELECT day AS time_bucket, event_name, COUNT(*) AS cnt FROM ev
WHERE event_name IN (SELECT event_name FROM ev GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 15) GROUP BY 1, 2""",
        "heatmap_pivot": f"WITH {EVENTS} SELECT day AS time_bucket, {STAGE_COUNTS} FROM ev GROUP BY 1",
        "hour_distribution": f"""WITH {EVENTS}
SELECT CAST(hour(event_time) AS INTEGER) AS hour_of_day, COUNT(*) AS cnt, {count_of('purchase', 'purchase_events')}
FROM ev GROUP BY 1""",
        "base_event_counts": f"WITH {EVENTS} SELECT event_name, COUNT(*) AS cnt FROM ev GROUP BY 1",
        "time_range": f"""WITH {EVENTS} SELECT event_name, COUNT(*) AS cnt FROM ev
WHERE event_time >= TIMESTAMP '2024-01-08 06:30:00' AND event_time < TIMESTAMP '2024-01-21 18:00:00' GROUP BY 1""",
        "free_sql": f"""WITH {SILVER}
SELECT strftime(event_time, '%Y-%m') AS month, status, COUNT(*) AS purchases, ROUND(SUM({AMOUNT}), 2) AS revenue_usd
FROM silver WHERE {PURCHASE} GROUP BY 1, 2""",
        "snapshot_counts": f"""WITH {MESSAGES}
SELECT product_id, name AS event_name, COUNT(*) AS count FROM named
WHERE seq % 23 <> 0 AND seq % 29 <> 0 AND product_id IS NOT NULL AND name IS NOT NULL GROUP BY 1, 2""",
        "snapshot_latest": f"WITH {COUNTS} SELECT product_id, event_name, n AS count FROM counts",
        "snapshot_hashes": f"WITH {COUNTS} SELECT product_id, event_name, n AS count FROM counts",
        "snapshot_mix": f"WITH {COUNTS} SELECT product_id, event_name, n AS count FROM counts",
        "snapshot_by_event": f"""WITH {COUNTS}
SELECT event_name, n AS count, products AS active_products, CAST(n AS DOUBLE) / SUM(n) OVER () AS share,
       round_even(CAST(n AS DOUBLE) / products, 2) AS avg_per_active_product,
       round_even(CAST(n AS DOUBLE) / SUM(n) OVER () * 100.0, 2) AS share_pct FROM per_event""",
        "snapshot_by_product": f"""WITH {COUNTS}
SELECT product_id, n AS count, kinds AS event_types, CAST(n AS DOUBLE) / SUM(n) OVER () AS share,
       round_even(CAST(n AS DOUBLE) / SUM(n) OVER () * 100.0, 2) AS share_pct FROM per_product""",
        "snapshot_kpis": f"""WITH {COUNTS}, total AS (SELECT SUM(n) AS t FROM counts)
SELECT CAST((SELECT t FROM total) AS BIGINT) AS total_interactions,
       (SELECT COUNT(*) FROM per_product) AS active_products, (SELECT COUNT(*) FROM per_event) AS event_types,
       CAST(floor((SELECT t FROM total) / (SELECT COUNT(*) FROM per_product)) AS BIGINT) AS avg_per_product,
       (SELECT CAST(MAX(n) AS DOUBLE) FROM per_product) / (SELECT t FROM total) AS top_product_share,
       (SELECT CAST(SUM(n) AS DOUBLE) FROM (SELECT n FROM per_product ORDER BY n DESC LIMIT 5)) / (SELECT t FROM total) AS top5_product_share,
       (SELECT CAST(MAX(n) AS DOUBLE) FROM per_event) / (SELECT t FROM total) AS top_event_share,
       (SELECT CAST(SUM(n) AS DOUBLE) FROM (SELECT n FROM per_event ORDER BY n DESC LIMIT 3)) / (SELECT t FROM total) AS top3_event_share,
       {per(stage('purchase'), '(SELECT t FROM total)')} AS purchase_share,
       {per(stage('add_to_cart'), stage('product_view'))} AS view_to_cart,
       {per(stage('begin_checkout'), stage('add_to_cart'))} AS cart_to_checkout,
       {per(stage('purchase'), stage('begin_checkout'))} AS checkout_to_purchase""",
        "funnel_snapshot": f"""WITH {COUNTS}
SELECT pos, event_name, n AS count, CAST(n AS DOUBLE) / SUM(n) OVER () AS share,
       round_even(CAST(n AS DOUBLE) / SUM(n) OVER () * 100.0, 2) AS share_pct FROM stages""",
        "funnel_ratios": f"""WITH {COUNTS}
SELECT {per(stage('add_to_cart'), stage('product_view'))} AS view_to_cart,
       {per(stage('begin_checkout'), stage('add_to_cart'))} AS cart_to_checkout,
       {per(stage('purchase'), stage('begin_checkout'))} AS checkout_to_purchase,
       {per(stage('purchase'), '(SELECT SUM(n) FROM stages)')} AS purchase_of_total""",
        "purchase_products": f"""WITH {COUNTS}
SELECT product_id, n AS purchase_count, CAST(n AS DOUBLE) / SUM(n) OVER () AS share,
       round_even(CAST(n AS DOUBLE) / SUM(n) OVER () * 100.0, 2) AS share_pct
FROM counts WHERE {PURCHASE}""",
        "pareto_events": pareto_query("per_event", "event_name"),
        "pareto_products": pareto_query("per_product", "product_id"),
        "drilldown_candidates": f"""WITH {COUNTS}
SELECT product_id, n AS count FROM per_product ORDER BY n DESC, product_id LIMIT 200""",
        "drilldown": f"""WITH {COUNTS}, {BUSIEST}
SELECT event_name, n AS count, CAST(n AS DOUBLE) / SUM(n) OVER () AS share,
       round_even(CAST(n AS DOUBLE) / SUM(n) OVER () * 100.0, 2) AS share_pct FROM chosen""",
        "drilldown_totals": f"""WITH {COUNTS}, {BUSIEST}
SELECT CAST(SUM(n) AS BIGINT) AS total, COUNT(DISTINCT event_name) AS event_types,
       {per(f"SUM(CASE WHEN {PURCHASE} THEN n ELSE 0 END)", "SUM(n)")} AS purchase_share FROM chosen""",
        "display_texts": f"""WITH {COUNTS}
SELECT event_name, replace(format('{{:,}}', n * 1000), ',', '.') AS count_text,
       printf('%.1f%%', CAST(n AS DOUBLE) / SUM(n) OVER () * 100.0) AS share_text,
       'US$ ' || format('{{:,.2f}}', n * 12.5::DOUBLE) AS money_text FROM per_event""",
        "purchase_lookup": f"""WITH {COUNTS}
SELECT CAST(COALESCE(SUM(n), 0) AS DOUBLE) AS value FROM per_event WHERE {PURCHASE}""",
        "batch_event_counts": f"""WITH {EVENTS}
SELECT event_name, COUNT(*) AS batch_cnt, CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () AS batch_share
FROM ev GROUP BY 1""",
        "batch_kpis": f"""WITH {EVENTS}, mix AS (SELECT event_name, COUNT(*) AS events FROM ev GROUP BY 1)
SELECT COUNT(*) AS rows, CAST(SUM(events) AS BIGINT) AS total, COUNT(DISTINCT event_name) AS series,
       CAST(MAX(events) AS DOUBLE) / SUM(events) AS top_share FROM mix""",
        "combined_view": f"""WITH {BOTH}
SELECT event_name, b AS batch_cnt, s AS realtime_cnt, s - b AS delta_speed_minus_batch,
       round_even(bs * 100.0, 2) AS batch_share_pct, round_even(ss * 100.0, 2) AS realtime_share_pct,
       round_even((ss - bs) * 100.0, 2) AS share_delta_pp FROM both_layers""",
        "combined_totals": f"""WITH {BOTH}
SELECT CAST(SUM(b) AS BIGINT) AS batch_events, CAST(SUM(s) AS BIGINT) AS realtime_events,
       MAX(CASE WHEN {PURCHASE} THEN bs END) AS batch_purchase_share,
       MAX(CASE WHEN {PURCHASE} THEN ss END) AS realtime_purchase_share FROM both_layers""",
        "combined_long": f"""WITH {BOTH},
busiest AS (SELECT * FROM both_layers ORDER BY greatest(b, s) DESC, event_name LIMIT 5)
SELECT event_name, 'batch_cnt' AS layer, b AS value FROM busiest
UNION ALL SELECT event_name, 'realtime_cnt', s FROM busiest""",
        "windowed_counts": f"""WITH {EVENTS}
SELECT strftime(date_trunc('hour', event_time), '%Y-%m-%dT%H:%M:%SZ') AS window_start, product_id, event_name,
       COUNT(*) AS count FROM ev WHERE product_id IS NOT NULL GROUP BY 1, 2, 3""",
        "lenient_numbers": f"""WITH {EVENTS} SELECT seq,
  CAST(CASE seq % 5 WHEN 0 THEN trunc(round(value, 2)) WHEN 1 THEN 1000 ELSE 0 END AS BIGINT) AS whole,
  CAST(CASE seq % 5 WHEN 0 THEN CAST(printf('%.2f', value) AS DOUBLE) WHEN 1 THEN 1000 ELSE 0 END AS DOUBLE) AS number FROM ev""",
        "iso_times": f"""WITH {EVENTS}, s AS (SELECT seq, event_time AS t FROM ev)
SELECT seq, CASE seq % 5 WHEN 0 THEN strftime(t, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN strftime(t, '%Y-%m-%dT%H:%M:%SZ')
  WHEN 2 THEN strftime(t - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:00Z') WHEN 3 THEN strftime(t, '%Y-%m-%dT00:00:00Z') END AS at
FROM s""",
        "day_range_counts": f"""WITH {EVENTS} SELECT event_name, COUNT(*) AS cnt FROM ev
WHERE day BETWEEN '2024-01-08' AND '2024-01-15' GROUP BY 1""",
        "exact_counts_unaligned": f"""WITH {EVENTS}
SELECT event_name, COUNT(*) AS count FROM ev WHERE product_id IS NOT NULL GROUP BY 1""",
        "deduplicated_events": f"""WITH {EVENTS} SELECT event_name, COUNT(*) AS events, CAST(SUM(seq) AS BIGINT) AS ids
FROM ev GROUP BY 1""",
        "cart_mismatches": f"""WITH {CARTS}
SELECT event_id, qty AS replayed_qty FROM replayed
WHERE event_name NOT IN ('product_view', 'click') AND hour(event_time) % 6 = 0""",
        "event_table_orders": f"""WITH {MESSAGES}
SELECT seq, 'O' || CAST(seq AS VARCHAR) AS order_id, product_id AS line_product FROM (
  SELECT seq, 'SKU' || lpad(CAST(k + 1 AS VARCHAR), 5, '0') AS product_id FROM named
  WHERE seq % 23 <> 0 AND seq % 29 <> 0 AND name = 'purchase' AND event_name = 'purchase' AND seq % 5 <> 0 AND seq % 47 <> 0)""",
        "line_total_mismatches": f"""WITH {ORDER_EVENTS}
SELECT event_id, CAST(line AS INTEGER) AS line FROM items WHERE l_linenumber % 6 = 0 AND line = 0""",
        "exact_counts": f"""WITH {EVENTS}
SELECT event_name, COUNT(*) AS count FROM ev WHERE product_id IS NOT NULL GROUP BY 1""",
        "parsed_events": f"""WITH {MESSAGES}
SELECT day, name AS event_name, 'mobile' AS device_type, COUNT(*) AS events,
       COUNT(CASE WHEN seq % 47 <> 0 THEN 1 END) AS with_order, CAST(SUM(quantity) AS BIGINT) AS quantity,
       ROUND(SUM(CASE WHEN seq % 47 <> 0 THEN revenue END), 2) AS order_total
FROM named WHERE seq % 23 <> 0 AND seq % 29 <> 0 GROUP BY 1, 2""",
        "contract_violations": f"WITH {MESSAGES} SELECT seq, reasons FROM checked WHERE reasons <> ''",
        "violation_counts": f"""WITH {MESSAGES}
SELECT reason, CASE WHEN reason <> 'unparsable' THEN name END AS event_name, COUNT(*) AS events
FROM (SELECT name, unnest(string_split(reasons, ',')) AS reason FROM checked WHERE reasons <> '') GROUP BY 1, 2""",
        "cart_replay": f"""WITH {CARTS}
SELECT event_id, cart_id, event_name, qty AS replayed_qty, CAST(worth AS DOUBLE) AS replayed_value
FROM replayed WHERE event_name NOT IN ('product_view', 'click')""",
        "streamed_cart_totals": f"""WITH {CARTS}
SELECT event_id, cart_id, event_name, qty AS replayed_qty, CAST(worth AS DOUBLE) AS replayed_value
FROM replayed WHERE event_name NOT IN ('product_view', 'click')""",
        "late_cart_totals": f"""WITH {CARTS}
SELECT event_id, cart_id, event_name, qty AS replayed_qty, CAST(worth AS DOUBLE) AS replayed_value
FROM replayed WHERE event_name NOT IN ('product_view', 'click')""",
        "late_rows": f"""WITH {LATE}
SELECT name AS event_name, COUNT(*) AS late_rows, COUNT(DISTINCT date_trunc('hour', sent_at)) AS windows FROM late GROUP BY 1""",
        "exact_counts_late": f"""WITH {MESSAGES}
SELECT name AS event_name, COUNT(*) AS count FROM named
WHERE seq % 23 <> 0 AND seq % 29 <> 0 AND product_id IS NOT NULL GROUP BY 1""",
        "streamed_sessions": f"""WITH {EVENTS},
gaps AS (SELECT session_id, event_time, event_name, CASE WHEN event_time > LAG(event_time) OVER (
           PARTITION BY session_id ORDER BY event_time) + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS fresh FROM ev),
runs AS (SELECT *, SUM(fresh) OVER (PARTITION BY session_id ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS run FROM gaps),
closed AS (SELECT session_id, run, MIN(event_time) AS started FROM runs GROUP BY 1, 2
           HAVING MAX(event_time) + INTERVAL 6 HOUR <= (SELECT MAX(event_time) FROM ev) - INTERVAL 10 MINUTE)
SELECT session_id, strftime(started, '%Y-%m-%dT%H:%M:%SZ') AS session_start, event_name,
       strftime(MIN(event_time), '%Y-%m-%dT%H:%M:%SZ') AS first_time,
       strftime(MAX(event_time), '%Y-%m-%dT%H:%M:%SZ') AS last_time, COUNT(*) AS events
FROM runs JOIN closed USING (session_id, run) GROUP BY session_id, run, started, event_name""",
        "compacted_event_table": f"""WITH {EVENTS}
SELECT day, event_name, COUNT(*) AS events, CAST(SUM(seq) AS BIGINT) AS ids FROM ev GROUP BY 1, 2""",
        "rollup_channels": f"""WITH {SILVER}
SELECT COALESCE(channel, 'unknown') AS dimension, COUNT(*) AS events, {count_of('product_view', 'product_views')},
       {count_of('add_to_cart', 'add_to_cart')}, {count_of('begin_checkout', 'begin_checkout')},
       {count_of('purchase', 'purchase_events')},
       CAST(SUM(CASE WHEN {PURCHASE} THEN {UNITS} ELSE 0 END) AS BIGINT) AS units_sold,
       ROUND(SUM(CASE WHEN {PURCHASE} THEN {AMOUNT} ELSE 0 END), 2) AS revenue_usd,
       ROUND(SUM(CASE WHEN {PURCHASE} THEN {SALES} ELSE 0 END), 2) AS total_sales_usd, TRUE AS estimates_hold
FROM silver WHERE day BETWEEN '2024-01-08' AND '2024-01-21' GROUP BY 1""",
        "top_visitors": f"""WITH {EVENTS}
SELECT user_id, COUNT(*) AS count FROM ev GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
        "price_changes": f"""WITH {EVENTS},
shown AS (SELECT product_id, event_time, seq, ROUND(price, -1) AS price FROM ev
          WHERE event_name IN ('product_view', 'click') AND price IS NOT NULL AND product_id IS NOT NULL),
changed AS (SELECT * FROM shown QUALIFY price IS DISTINCT FROM LAG(price) OVER (PARTITION BY product_id ORDER BY event_time, seq))
SELECT product_id, price, strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') AS valid_from,
       strftime(LEAD(event_time) OVER (PARTITION BY product_id ORDER BY event_time, seq), '%Y-%m-%dT%H:%M:%SZ') AS valid_to
FROM changed""",
        "price_mismatches": f"""WITH {EVENTS},
both_kinds AS (SELECT product_id, event_time, seq, ROUND(price, -1) AS price, event_name = 'purchase' AS is_line FROM ev
               WHERE product_id IS NOT NULL AND event_name IN ('product_view', 'click', 'purchase')),
priced AS (SELECT *, LAST_VALUE(CASE WHEN NOT is_line THEN price END IGNORE NULLS) OVER (
             PARTITION BY product_id ORDER BY event_time, is_line, seq ROWS UNBOUNDED PRECEDING) AS catalogue_price FROM both_kinds)
SELECT seq, product_id, price, catalogue_price FROM priced WHERE is_line AND abs(price - catalogue_price) >= 0.005""",
        "snapshot_change_feed": f"""WITH {MESSAGES},
span AS (SELECT MIN(CAST(floor(epoch(event_time)) AS BIGINT)) AS lo, MAX(CAST(floor(epoch(event_time)) AS BIGINT)) AS hi FROM ev),
sent AS (SELECT product_id, name, (CAST(floor(epoch(event_time)) AS BIGINT) - lo) // ((hi - lo) // 3 + 1) > 0 AS later
         FROM named, span WHERE seq % 23 <> 0 AND seq % 29 <> 0 AND product_id IS NOT NULL AND name IS NOT NULL)
SELECT product_id, name AS event_name, nullif(COUNT(*) FILTER (NOT later), 0) AS before, COUNT(*) AS count,
       COUNT(*) FILTER (later) AS delta FROM sent GROUP BY 1, 2 HAVING COUNT(*) FILTER (later) > 0""",
        "json_lines": f"""WITH {MESSAGES}
SELECT name AS event_name, COUNT(*) AS events, COUNT(product_id) AS with_product FROM named
WHERE seq % 23 <> 0 AND seq % 29 <> 0 GROUP BY 1""",
        "cart_rules": f"""WITH {CARTS},
before AS (
  SELECT event_id, event_name, quantity, CAST(after - delta AS BIGINT) AS held_qty FROM replayed
  WHERE event_name IN ('update_cart', 'remove_from_cart')
)
SELECT event_id, held_qty, CASE WHEN held_qty <= 0 THEN 'not_in_cart' ELSE 'other_quantity_removed' END AS reasons
FROM before WHERE held_qty <= 0 OR (event_name = 'remove_from_cart' AND quantity <> held_qty)""",
        "landed_messages": f"""WITH {EVENTS}
SELECT COUNT(*) AS messages, COUNT(CASE WHEN seq % 23 = 0 THEN 1 END) AS broken,
       CAST(SUM(CASE WHEN seq % 23 <> 0 THEN seq END) AS BIGINT) AS ids FROM ev""",
        "event_table_stream": f"""WITH {MESSAGES}
SELECT day, name AS event_name, COUNT(*) AS events FROM checked WHERE reasons = '' GROUP BY 1, 2""",
        "quarantine_stream": f"""WITH {MESSAGES}
SELECT reasons, COUNT(*) AS messages FROM checked WHERE reasons <> '' GROUP BY 1""",
        "csv_round_trip": EVENT_MIX,
        "snapshot_counts_restarted": f"""WITH {MESSAGES}
SELECT product_id, name AS event_name, COUNT(*) AS count FROM named
WHERE seq % 23 <> 0 AND seq % 29 <> 0 AND product_id IS NOT NULL AND name IS NOT NULL GROUP BY 1, 2""",
        "session_stages": f"""WITH {EVENTS}
SELECT session_id, event_name, strftime(MIN(event_time), '%Y-%m-%dT%H:%M:%SZ') AS first_time,
       strftime(MAX(event_time), '%Y-%m-%dT%H:%M:%SZ') AS last_time, COUNT(*) AS events FROM ev GROUP BY 1, 2""",
        "session_conformance": f"""WITH {CARTS},
steps AS (
  SELECT *, COALESCE(LAG(CASE WHEN event_name = 'begin_checkout' THEN 1 WHEN event_name = 'purchase' THEN 0 END IGNORE NULLS)
           OVER (PARTITION BY session_id ORDER BY event_time, event_id), 0) AS open
  FROM replayed WHERE event_name IN ('begin_checkout', 'checkout_progress', 'purchase')
),
found AS (
  SELECT session_id, event_id, event_name, concat_ws(',',
    CASE WHEN event_name = 'begin_checkout' AND open = 1 THEN 'checkout_already_open' END,
    CASE WHEN event_name <> 'begin_checkout' AND open = 0 THEN 'no_open_checkout' END,
    CASE WHEN event_name <> 'checkout_progress' AND qty <= 0 THEN 'empty_cart' END) AS reasons FROM steps
)
SELECT * FROM found WHERE reasons <> ''""",
        "order_lines": f"""WITH {ORDER_EVENTS}
SELECT event_id, order_id, CAST(line AS INTEGER) AS line, product_id, category, CAST(price AS DOUBLE) AS price,
       CAST(quantity AS INTEGER) AS quantity,
       CAST(price * quantity AS DOUBLE) AS line_total FROM items""",
        "product_sales": f"""WITH {ORDER_EVENTS}
SELECT product_id, COUNT(*) AS lines, COUNT(DISTINCT order_id) AS orders, CAST(SUM(quantity) AS BIGINT) AS units,
       CAST(SUM(price * quantity) AS DOUBLE) AS revenue FROM items GROUP BY 1""",
        "order_reconciliation": f"""WITH {ORDER_EVENTS},
summed AS (
  SELECT rid, event_id, order_id, l_shipdate, l_linenumber, CAST(SUM(price * quantity) AS DOUBLE) AS items_value,
         CAST(SUM(quantity) AS BIGINT) AS items_qty FROM items GROUP BY 1, 2, 3, 4, 5
)
SELECT event_id, order_id, items_value + CASE WHEN day(l_shipdate) % 5 = 0 THEN 1.0 ELSE 0.0 END AS revenue,
       items_value AS cart_value, CAST(items_qty + CASE WHEN l_linenumber % 7 = 0 THEN 1 ELSE 0 END AS INTEGER) AS cart_items_qty,
       items_value, items_qty,
       concat_ws(',', CASE WHEN day(l_shipdate) % 5 = 0 THEN 'revenue' END,
                 CASE WHEN l_linenumber % 7 = 0 THEN 'cart_items_qty' END) AS differing
FROM summed WHERE day(l_shipdate) % 5 = 0 OR l_linenumber % 7 = 0""",
        "product_catalog": f"""WITH {EVENTS}, {ORDER_EVENTS},
seen AS (
  SELECT product_id, event_time, price, NULL AS name, NULL AS category FROM ev
  UNION ALL
  SELECT product_id, l_shipdate, CAST(price AS DOUBLE), name, category FROM items
)
SELECT product_id, arg_max(price, (event_time, price)) FILTER (price IS NOT NULL) AS price,
       arg_max(name, (event_time, name)) FILTER (name IS NOT NULL) AS name,
       arg_max(category, (event_time, category)) FILTER (category IS NOT NULL) AS category,
       strftime(MAX(event_time), '%Y-%m-%dT%H:%M:%SZ') AS last_seen
FROM seen WHERE product_id IS NOT NULL GROUP BY 1""",
        "top_channels": bars_query("channel", "orders"),
        "top_countries": bars_query("customer_country", "buyers"),
        "top_products": bars_query("product", "total_sales_usd"),
        "top_cities": bars_query("city", "revenue_usd"),
    }
    sql.update({f"dim_{name}": dimension_query(name) for name in DIMENSIONS})
    sql.update({f"page_{name}": page_query(name) for name in DIMENSIONS})
    sql.update({f"product_{name}": product_query(name) for name, d in DIMENSIONS.items()
                if d[0] == "product"})
    return sql
