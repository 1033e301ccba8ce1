"""The fixture views in SQL, independent of the Spark code.

Each view is named ``v_<view>``. ``with_views`` puts the ones a query needs, and
those they need in turn, in front of it as common table expressions.
"""

from __future__ import annotations

import re

AS_OF_ORDERS = "TIMESTAMP '2001-08-02 00:00:00'"
AS_OF_EVENTS = "TIMESTAMP '2024-01-31 00:00:00'"

VIEWS = {
    "v_customers": """
        SELECT c_custkey AS customer_id,
               split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               CASE WHEN c_custkey % 97 = 1 THEN NULL
                    WHEN c_custkey % 101 = 2 THEN '  '
                    ELSE lower(split_part(c_name, '#', 1)) || split_part(c_name, '#', 2) || '@example.com' END AS email,
               TIMESTAMP '1994-01-01 00:00:00' + to_days(CAST(c_custkey % 2700 AS INTEGER)) AS signup_ts,
               n_name AS country,
               c_acctbal >= 0 AS is_active,
               c_acctbal > 9000 AS vip,
               c_mktsegment AS mktsegment
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "v_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_ts,
               CASE WHEN o_orderkey % 20 = 0 THEN 'CANCELLED' WHEN o_orderstatus = 'F' THEN 'COMPLETED'
                    WHEN o_orderstatus = 'P' THEN 'REFUNDED' WHEN o_orderstatus = 'O' THEN 'PENDING' END AS order_status,
               CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
               'USD' AS currency,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'WEB' WHEN '2-HIGH' THEN 'MOBILE' WHEN '3-MEDIUM' THEN 'RETAIL'
                    WHEN '4-NOT SPECIFIED' THEN 'PARTNER' WHEN '5-LOW' THEN 'CALLCENTER' END AS channel,
               lpad(CAST(o_orderkey AS VARCHAR), 16, '0') AS card_pan
        FROM orders""",
    "v_order_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS line_no, 'SKU-' || l_partkey AS sku,
               CAST(l_quantity AS DECIMAL(8,0)) AS quantity,
               CAST(CAST((2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(round(l_quantity) AS BIGINT))
                    // (2 * CAST(round(l_quantity) AS BIGINT)) AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(2,2))
                    AS DECIMAL(10,2)) AS unit_price,
               CAST(round(abs(l_discount) * 100) AS DECIMAL(5,2)) AS discount_pct
        FROM lineitem""",
    "v_products": """
        SELECT 'SKU-' || p_partkey AS sku, p_name AS name, p_type AS category,
               CAST(p_retailprice AS DECIMAL(10,2)) AS list_price
        FROM part""",
    "v_user_events": """
        SELECT event_id, user_id, ts AS event_ts,
               CASE WHEN event_type = 'purchase' THEN 'CART_VIEWED' ELSE event_type END AS event_type,
               CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
               CASE event_id % 5 WHEN 0 THEN 'google' WHEN 1 THEN 'email' WHEN 2 THEN 'social' WHEN 3 THEN 'direct' END
                   AS utm_source,
               CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(12,2)) END AS order_total,
               'NATION_' || (user_id % 25) AS country,
               (user_id % 180) - 90 + (event_id % 100) / 100.0::DOUBLE AS lat,
               (user_id % 360) - 180 + (event_id % 50) / 50.0::DOUBLE AS lon,
               'C' || (user_id % 7) AS campaign_id
        FROM events""",
    "v_raw_events": """
        SELECT event_id, ts AS received_ts, event_id % 50 = 0 AS broken,
               CASE WHEN event_type = 'view' THEN 'page_view' ELSE event_type END AS type,
               user_id, 'NATION_' || (user_id % 25) AS country,
               date_trunc('second', ts) AS event_ts,
               CASE WHEN event_type = 'purchase' THEN 'o-' || event_id END AS order_id,
               CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(12,2)) END AS order_total,
               value AS raw_value,
               CASE WHEN event_type = 'purchase' THEN CAST(event_id % 3 + 1 AS INTEGER) END AS item_count
        FROM events""",
    "v_raw_items": """
        SELECT e.event_id, CAST(i.n AS INTEGER) AS idx, 'S' || ((e.event_id + i.n + 1) % 500) AS sku,
               CAST((e.event_id + i.n + 1) % 4 + 1 AS DECIMAL(38,0)) AS qty,
               CAST((e.event_id * 13 + (i.n + 1) * 7) % 10000 / 100.0 AS DECIMAL(10,2)) AS unit_price
        FROM v_raw_events e JOIN (SELECT unnest([0, 1, 2]) AS n) i ON i.n < e.item_count
        WHERE NOT e.broken""",
    "v_categories": """
        SELECT 'R' || r_regionkey AS category_id, CAST(NULL AS VARCHAR) AS parent_id, r_name AS name FROM region
        UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, n_name FROM nation
        UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey, s_name FROM supplier""",
    "v_sessionised": """
        SELECT *, sum(is_session_start) OVER (PARTITION BY user_id ORDER BY event_ts, event_id
                                              ROWS UNBOUNDED PRECEDING)::BIGINT AS session_no
        FROM (SELECT *, CASE WHEN prev_ts IS NULL OR date_diff('second', prev_ts, event_ts) > 21600
                             THEN 1 ELSE 0 END AS is_session_start
              FROM (SELECT *, lag(event_ts) OVER (PARTITION BY user_id ORDER BY event_ts, event_id) AS prev_ts
                    FROM v_user_events))""",
    "v_sessions": """
        SELECT user_id, session_no, min(event_ts) AS session_start, max(event_ts) AS session_end,
               date_diff('second', min(event_ts), max(event_ts)) AS duration_s, count(*) AS event_count,
               CAST(sum(coalesce(order_total, 0)) AS DECIMAL(12,2)) AS gmv,
               string_agg(DISTINCT utm_source, '|' ORDER BY utm_source) AS utm_sources,
               round(quantile_cont(lat, 0.5), 6) AS median_lat, round(quantile_cont(lon, 0.5), 6) AS median_lon,
               min(country) AS country, min(device_type) AS device_type
        FROM v_sessionised WHERE event_ts >= TIMESTAMP '2024-01-01 00:00:00'
        GROUP BY user_id, session_no""",
    "v_session_lookup": """
        SELECT user_id || '-' || session_no AS session_id, user_id,
               CASE WHEN user_id % 11 = 3 THEN 'user' || user_id ELSE ' User' || user_id || '@Example.com ' END AS user_email,
               session_start, session_end
        FROM (SELECT user_id, session_no, min(event_ts) AS session_start, max(event_ts) AS session_end
              FROM v_sessionised GROUP BY user_id, session_no)
        WHERE session_no % 5 <> 0""",
    "v_daily_channel_metrics": """
        SELECT CAST(order_ts AS DATE) AS day,
               CAST(sum(total_amount) FILTER (channel = 'WEB') AS DECIMAL(12,2)) AS web_spend,
               CAST(sum(total_amount) FILTER (channel = 'MOBILE') AS DECIMAL(12,2)) AS mobile_spend,
               CASE WHEN date_diff('day', DATE '1970-01-01', CAST(order_ts AS DATE)) % 4 <> 0
                    THEN CAST(sum(total_amount) FILTER (channel = 'RETAIL') AS DECIMAL(12,2)) END AS retail_spend,
               CAST(sum(total_amount) FILTER (channel = 'PARTNER') AS DECIMAL(12,2)) AS partner_spend
        FROM v_orders GROUP BY CAST(order_ts AS DATE)""",
    "v_campaign_attribution": """
        SELECT user_id AS customer_id, 'C' || (user_id % 7) AS campaign_id, ts AS last_touch_ts,
               CAST(value AS DECIMAL(12,2)) AS attribution_pct
        FROM events WHERE event_type = 'click'""",
    # The bounds of an amount's class, both included; what none holds is a whale.
    "v_amount_classes": """
        SELECT * FROM (VALUES ('micro', -1e12, 24.99), ('small', 25, 99.99), ('medium', 100, 499), ('large', 500, 1999)) t(class, low, high)""",
    # Who sees addresses in clear, and who sees customers of every country.
    "v_roles": """
        SELECT * FROM (VALUES ('ACCOUNTADMIN', false, true), ('SECURITY_ADMIN', true, true), ('PII_ADMIN', true, false), ('R0', false, false))
            t(role, sees_clear, sees_all)""",
    "v_role_map": """
        SELECT 'R' || (n_nationkey % 3) AS role_name, n_name AS country FROM nation
        UNION ALL SELECT 'PII_ADMIN', n_name FROM nation WHERE n_nationkey % 3 = 1""",
    "v_bronze": """
        SELECT order_id, customer_id, order_ts, order_status, total_amount FROM v_orders""",
    "v_bronze1": """
        SELECT order_id, customer_id, order_ts, order_status, total_amount FROM v_orders WHERE order_id % 10 <> 9""",
    "v_bronze2": """
        SELECT order_id, CASE WHEN order_id % 500 = 7 THEN -1 ELSE customer_id END AS customer_id, order_ts, order_status,
               CAST(CASE WHEN order_id % 10 = 3 THEN total_amount + 1 ELSE total_amount END AS DECIMAL(12,2)) AS total_amount
        FROM v_orders WHERE order_id % 50 <> 0""",
    "v_feed": """
        SELECT coalesce(n.order_id, o.order_id) AS order_id, a.action, o.order_id IS NOT NULL AND n.order_id IS NOT NULL AS is_update,
               CASE WHEN a.action = 'DELETE' THEN o.customer_id ELSE n.customer_id END AS customer_id,
               CASE WHEN a.action = 'DELETE' THEN o.order_ts ELSE n.order_ts END AS order_ts,
               CASE WHEN a.action = 'DELETE' THEN o.order_status ELSE n.order_status END AS order_status,
               CASE WHEN a.action = 'DELETE' THEN o.total_amount ELSE n.total_amount END AS total_amount
        FROM v_bronze1 o FULL JOIN v_bronze2 n ON o.order_id = n.order_id
        JOIN (SELECT unnest(['DELETE', 'INSERT']) AS action) a
          ON (a.action = 'DELETE' AND o.order_id IS NOT NULL) OR (a.action = 'INSERT' AND n.order_id IS NOT NULL)
        WHERE o.order_id IS NULL OR n.order_id IS NULL
           OR (o.customer_id, o.order_ts, o.order_status, o.total_amount)
              IS DISTINCT FROM (n.customer_id, n.order_ts, n.order_status, n.total_amount)""",
    "v_silver": """
        SELECT coalesce(b.order_id, f.order_id) AS order_id,
               CASE WHEN f.action = 'INSERT' AND (b.order_id IS NULL OR f.is_update) THEN f.customer_id ELSE b.customer_id END AS customer_id,
               CASE WHEN f.action = 'INSERT' AND (b.order_id IS NULL OR f.is_update) THEN f.order_ts ELSE b.order_ts END AS order_ts,
               CASE WHEN f.action = 'INSERT' AND (b.order_id IS NULL OR f.is_update) THEN f.order_status ELSE b.order_status END AS order_status,
               CASE WHEN f.action = 'INSERT' AND (b.order_id IS NULL OR f.is_update) THEN f.total_amount ELSE b.total_amount END AS total_amount,
               CASE WHEN f.action = 'INSERT' AND (b.order_id IS NULL OR f.is_update) THEN f.total_amount > 1000
                    ELSE b.total_amount > 1000 END AS is_high_value,
               b.order_id IS NOT NULL AND f.action IS NOT DISTINCT FROM 'DELETE' AS is_deleted
        FROM v_bronze1 b FULL JOIN (SELECT * FROM v_feed WHERE NOT (action = 'DELETE' AND is_update)) f
          ON b.order_id = f.order_id
        WHERE b.order_id IS NOT NULL OR f.action = 'INSERT'""",
    # Left by earlier runs: older segments and countries for some customers, two versions for others.
    "v_dim0": """
        SELECT row_number() OVER (ORDER BY customer_id, valid_from) AS customer_sk, *
        FROM (SELECT customer_id, full_name, email_hash, CASE WHEN customer_id % 13 = 5 THEN 'NATION_OLD' ELSE country END AS country,
                     CASE WHEN customer_id % 10 = 1 THEN CASE segment WHEN 'VIP' THEN 'STANDARD' ELSE 'VIP' END
                          ELSE segment END AS segment,
                     CASE WHEN customer_id % 7 = 2 THEN TIMESTAMP '1999-01-01 00:00:00' ELSE TIMESTAMP '2000-01-01 00:00:00' END
                         AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current
              FROM v_dim_source WHERE customer_id % 4 <> 3
              UNION ALL
              SELECT customer_id, full_name, email_hash, 'NATION_OLD', 'STANDARD', TIMESTAMP '1998-01-01 00:00:00',
                     TIMESTAMP '1999-01-01 00:00:00', false
              FROM v_dim_source WHERE customer_id % 4 <> 3 AND customer_id % 7 = 2)""",
    "v_dim_source": """
        SELECT customer_id, first_name || ' ' || last_name AS full_name, sha256(lower(email)) AS email_hash, country,
               CASE WHEN vip THEN 'VIP' ELSE 'STANDARD' END AS segment, signup_ts
        FROM v_customers""",
    "v_dim_scope": """
        SELECT * FROM v_dim_source
        WHERE signup_ts >= TIMESTAMP '2001-08-01 00:00:00' OR customer_id IN (SELECT customer_id FROM v_feed)""",
    "v_dim_expired": """
        SELECT d.customer_id FROM v_dim0 d JOIN v_dim_scope s USING (customer_id)
        WHERE d.is_current AND (d.email_hash <> s.email_hash OR d.country <> s.country OR d.segment <> s.segment)""",
    "v_dim_new": """
        SELECT (SELECT max(customer_sk) FROM v_dim0) + row_number() OVER (ORDER BY customer_id) AS customer_sk, *
        FROM (SELECT customer_id, full_name, email_hash, country, segment,
                     TIMESTAMP '2001-08-02 00:00:00' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current
              FROM v_dim_source WHERE customer_id IN (SELECT customer_id FROM v_dim_expired)
              UNION ALL
              SELECT customer_id, full_name, email_hash, country, segment, TIMESTAMP '2001-08-02 00:00:00', NULL, true
              FROM v_dim_scope WHERE customer_id NOT IN (SELECT customer_id FROM v_dim0))""",
    "v_dim": """
        SELECT customer_sk, customer_id, full_name, email_hash, country, segment, valid_from,
               CASE WHEN is_current AND customer_id IN (SELECT customer_id FROM v_dim_expired)
                    THEN TIMESTAMP '2001-08-02 00:00:00' ELSE valid_to END AS valid_to,
               is_current AND customer_id NOT IN (SELECT customer_id FROM v_dim_expired) AS is_current
        FROM v_dim0
        UNION ALL SELECT customer_sk, customer_id, full_name, email_hash, country, segment, valid_from, valid_to, is_current
        FROM v_dim_new""",
    "v_payloads": """
        SELECT order_id, count(*) AS line_count,
               '[' || string_agg('{"sku":"' || sku || '","qty":"' || quantity || '","price":"' || unit_price || '"}', ','
                                 ORDER BY sku, quantity, unit_price) || ']' AS payload
        FROM v_order_items GROUP BY order_id""",
    # Facts loaded by an earlier run: a third of the first bronze version.
    "v_fact0": """
        SELECT row_number() OVER (ORDER BY b.order_id) AS order_sk, b.order_id, d.customer_sk,
               CAST(b.order_ts AS DATE) AS order_date, b.order_status, CAST(b.total_amount AS DECIMAL(14,2)) AS gross_amount,
               CAST(0 AS DECIMAL(14,2)) AS tax_amount, CAST(b.total_amount AS DECIMAL(14,2)) AS net_amount,
               CAST(0 AS BIGINT) AS line_count, CAST(NULL AS VARCHAR) AS payload
        FROM v_bronze1 b JOIN v_dim0 d ON d.customer_id = b.customer_id AND d.is_current WHERE b.order_id % 3 = 0""",
    "v_fact_source": """
        SELECT f.order_id, f.action, d.customer_sk, CAST(f.order_ts AS DATE) AS order_date, f.order_status,
               CAST(f.total_amount AS DECIMAL(14,2)) AS gross_amount,
               CAST(f.total_amount * 0.08 AS DECIMAL(14,2)) AS tax_amount,
               CAST(f.total_amount * 0.92 AS DECIMAL(14,2)) AS net_amount,
               coalesce(p.line_count, 0) AS line_count, p.payload
        FROM v_feed f JOIN v_dim d ON d.customer_id = f.customer_id AND d.is_current
        LEFT JOIN v_payloads p ON p.order_id = f.order_id
        WHERE NOT (f.action = 'DELETE' AND f.is_update)""",
    "v_fact": """
        SELECT order_sk, order_id, customer_sk, order_date, order_status, gross_amount, tax_amount, net_amount, line_count, payload
        FROM v_fact0 WHERE order_id NOT IN (SELECT order_id FROM v_fact_source)
        UNION ALL
        SELECT t.order_sk, s.order_id, s.customer_sk, s.order_date, s.order_status, s.gross_amount, s.tax_amount,
               s.net_amount, s.line_count, s.payload
        FROM v_fact_source s JOIN v_fact0 t USING (order_id) WHERE s.action <> 'DELETE'
        UNION ALL
        SELECT (SELECT max(order_sk) FROM v_fact0) + row_number() OVER (ORDER BY order_id), order_id, customer_sk, order_date,
               order_status, gross_amount, tax_amount, net_amount, line_count, payload
        FROM v_fact_source WHERE action = 'INSERT' AND order_id NOT IN (SELECT order_id FROM v_fact0)""",
    "v_top_category": """
        SELECT customer_id, category, qty
        FROM (SELECT customer_id, category, qty,
                     row_number() OVER (PARTITION BY customer_id ORDER BY qty DESC, category) AS rn
              FROM (SELECT o.customer_id, p.category, CAST(sum(i.quantity) AS DECIMAL(18,0)) AS qty
                    FROM v_orders o JOIN v_order_items i USING (order_id) JOIN v_products p USING (sku)
                    WHERE o.order_ts >= TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 30 DAY
                    GROUP BY ALL))
        WHERE rn = 1""",
    "v_c360": """
        SELECT w.customer_id, DATE '2001-08-02' AS snapshot_date, w.total_spend_30d, w.order_count_30d, w.last_order_ts,
               t.category AS top_category, '{"country":"' || c.country || '","tier":"gold"}' AS traits
        FROM (SELECT customer_id, CAST(sum(total_amount) AS DECIMAL(18,2)) AS total_spend_30d,
                     CAST(count(*) AS INTEGER) AS order_count_30d, max(order_ts) AS last_order_ts
              FROM v_orders WHERE order_ts >= TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 30 DAY
                              AND order_ts < TIMESTAMP '2001-08-02 00:00:00' GROUP BY customer_id) w
        JOIN v_customers c ON c.customer_id = w.customer_id
        LEFT JOIN v_top_category t ON t.customer_id = w.customer_id
        WHERE c.country IN (SELECT country FROM v_customers WHERE is_active)""",
    "v_top_category_earlier": """
        SELECT customer_id, category, qty
        FROM (SELECT customer_id, category, qty,
                     row_number() OVER (PARTITION BY customer_id ORDER BY qty DESC, category) AS rn
              FROM (SELECT o.customer_id, p.category, CAST(sum(i.quantity) AS DECIMAL(18,0)) AS qty
                    FROM v_orders o JOIN v_order_items i USING (order_id) JOIN v_products p USING (sku)
                    WHERE o.order_ts >= TIMESTAMP '2001-07-01 00:00:00' - INTERVAL 30 DAY
                    GROUP BY ALL))
        WHERE rn = 1""",
    "v_c360_earlier": """
        SELECT w.customer_id, DATE '2001-07-01' AS snapshot_date, w.total_spend_30d, w.order_count_30d, w.last_order_ts,
               t.category AS top_category, '{"country":"' || c.country || '","tier":"gold"}' AS traits
        FROM (SELECT customer_id, CAST(sum(total_amount) AS DECIMAL(18,2)) AS total_spend_30d,
                     CAST(count(*) AS INTEGER) AS order_count_30d, max(order_ts) AS last_order_ts
              FROM v_orders WHERE order_ts >= TIMESTAMP '2001-07-01 00:00:00' - INTERVAL 30 DAY
                              AND order_ts < TIMESTAMP '2001-07-01 00:00:00' GROUP BY customer_id) w
        JOIN v_customers c ON c.customer_id = w.customer_id
        LEFT JOIN v_top_category_earlier t ON t.customer_id = w.customer_id
        WHERE c.country IN (SELECT country FROM v_customers WHERE is_active)""",
}

_NAME = re.compile(r"\bv_[a-z_0-9]+\b")


def with_views(sql: str) -> str:
    """``sql`` preceded by every view it needs, directly or through another."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in dict.fromkeys(_NAME.findall(text)):
            if name in VIEWS and name not in ordered:
                need(VIEWS[name])
                ordered.append(name)

    need(sql)
    if not ordered:
        return sql
    body = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in ordered)
    sql = sql.strip()
    if sql.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {body},\n{sql[len('WITH RECURSIVE'):]}"
    if sql.upper().startswith("WITH"):
        return f"WITH {body},\n{sql[len('WITH'):]}"
    return f"WITH {body}\n{sql}"
