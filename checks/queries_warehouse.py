from checks.views import AS_OF_ORDERS

_MERGED_360 = """
    SELECT coalesce(t.customer_id, s.customer_id) AS customer_id, coalesce(t.snapshot_date, s.snapshot_date) AS snapshot_date,
           CASE WHEN s.customer_id IS NULL THEN t.total_spend_30d ELSE s.total_spend_30d END AS total_spend_30d,
           CASE WHEN s.customer_id IS NULL THEN t.order_count_30d ELSE s.order_count_30d END AS order_count_30d,
           CASE WHEN s.customer_id IS NULL THEN 'keep' WHEN t.customer_id IS NULL THEN 'insert' ELSE 'update' END AS action
    FROM (SELECT customer_id, snapshot_date, total_spend_30d, order_count_30d FROM v_c360_earlier
          UNION ALL SELECT customer_id, snapshot_date, CAST(0 AS DECIMAL(18,2)), order_count_30d FROM v_c360 WHERE customer_id % 2 = 0) t
    FULL JOIN v_c360 s ON t.customer_id = s.customer_id AND t.snapshot_date = s.snapshot_date"""

_GOLD = """SELECT customer_id, CAST(order_ts AS DATE) AS order_date, count(*) AS order_count,
                  CAST(sum(total_amount) AS DECIMAL(14,2)) AS revenue, count_if(is_high_value)::BIGINT AS high_value_cnt"""

SQL = {
    "values_insert": """
        SELECT customer_id, first_name, last_name, email, CAST(signup_ts AS DATE) AS signup_date, country, is_active FROM v_customers
        UNION ALL
        SELECT (SELECT max(customer_id) FROM v_customers) + n, f, l, e, d, c, true
        FROM (VALUES (1, 'Mira', 'Okafor', 'mira@mail.test', DATE '2023-11-02', 'NG'),
                     (2, 'Jon', 'Petit', 'jon@mail.test', DATE '2024-04-18', 'FR'),
                     (3, 'Sana', 'Ito', 'sana@mail.test', DATE '2024-06-30', 'JP')) t(n, f, l, e, d, c)""",
    "update_inactive": f"""
        SELECT customer_id, CASE WHEN signup_ts < {AS_OF_ORDERS} - INTERVAL 3 YEAR THEN false ELSE is_active END AS is_active
        FROM v_customers""",
    "delete_blank_email": """
        SELECT customer_id, email FROM v_customers WHERE NOT coalesce(email IS NULL OR trim(email) = '', false)""",
    "surrogate_keys": """
        SELECT customer_id, row_number() OVER (ORDER BY signup_ts ASC NULLS LAST, customer_id) AS customer_sk FROM v_customers""",
    "merge_upsert": _MERGED_360,
    "merge_counts": f"SELECT action, count(*) AS n FROM ({_MERGED_360}) WHERE action <> 'keep' GROUP BY action",
    "merge_restore": """
        SELECT coalesce(t.order_id, s.order_id) AS order_id,
               CASE WHEN s.order_id IS NULL THEN t.total_amount ELSE s.total_amount END AS total_amount,
               CASE WHEN s.order_id IS NULL THEN t.order_status ELSE s.order_status END AS order_status,
               CASE WHEN t.order_id IS NULL THEN s.channel ELSE t.channel END AS channel,
               CASE WHEN t.order_id IS NULL THEN 'USD' ELSE 'EUR' END AS currency
        FROM (SELECT b.order_id, b.total_amount, b.order_status, o.channel FROM v_bronze2 b JOIN v_orders o USING (order_id)) t
        FULL JOIN (SELECT b.order_id, b.total_amount, b.order_status, o.channel FROM v_bronze1 b JOIN v_orders o USING (order_id)) s
          ON t.order_id = s.order_id""",
    "change_feed": "SELECT order_id, action, is_update, order_status, total_amount FROM v_feed",
    "cdc_silver_merge": "SELECT order_id, order_status, total_amount, is_high_value, is_deleted FROM v_silver",
    "cdc_gold_daily": f"""
        WITH old AS ({_GOLD} FROM (SELECT *, total_amount > 1000 AS is_high_value FROM v_bronze1) GROUP BY ALL),
        new AS ({_GOLD} FROM v_silver WHERE NOT is_deleted AND order_ts >= {AS_OF_ORDERS} - INTERVAL 30 DAY GROUP BY ALL)
        SELECT customer_id, order_date, order_count, revenue, high_value_cnt FROM new
        UNION ALL
        SELECT customer_id, order_date, order_count, revenue, high_value_cnt FROM old
        WHERE (customer_id, order_date) NOT IN (SELECT (customer_id, order_date) FROM new)""",
    "late_orders_alert": f"""
        SELECT CAST({AS_OF_ORDERS} AS TIMESTAMP) AS alert_ts, 'WARN' AS level, 'Late orders: ' || count(*) || ' rows past SLA' AS message
        FROM v_silver WHERE order_status = 'PENDING' AND date_diff('hour', order_ts, {AS_OF_ORDERS}) > 24 HAVING count(*) > 0""",
    "scd2_customers": """
        SELECT customer_id, valid_from, valid_to, is_current, full_name, email_hash, country, segment FROM v_dim""",
    "fact_merge": """
        SELECT order_sk, order_id, customer_sk, order_date, order_status, gross_amount, tax_amount, net_amount, line_count, payload FROM v_fact""",
    "bridge_rebuild": """
        SELECT order_sk, 'OLD' AS category, CAST(1 AS DECIMAL(14,4)) AS revenue_share FROM v_fact0
        WHERE order_sk NOT IN (SELECT order_sk FROM v_fact WHERE order_date = DATE '2001-07-20')
        UNION ALL
        SELECT order_sk, category,
               CAST((2 * CAST(revenue * 100 AS HUGEINT) * 10000 + CAST(gross_amount * 100 AS HUGEINT))
                    // (2 * CAST(gross_amount * 100 AS HUGEINT)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(14,4))
        FROM (SELECT f.order_sk, p.category, f.gross_amount, sum(i.quantity * i.unit_price) AS revenue
              FROM v_fact f JOIN v_order_items i USING (order_id) JOIN v_products p USING (sku)
              WHERE f.order_date = DATE '2001-07-20' GROUP BY ALL)""",
    "orphan_rejects": """
        SELECT 'ORPHAN_CUSTOMER' AS reason, '{"order_id":' || order_id || ',"customer_id":' || f.customer_id || '}' AS raw
        FROM v_feed f WHERE action = 'INSERT'
          AND NOT EXISTS (SELECT 1 FROM v_dim d WHERE d.customer_id = f.customer_id AND d.is_current)""",
    # A version belongs to the history when no gap lies between it and the current one; its depth is its place from there.
    "vip_history": """
        SELECT customer_id, customer_sk, segment, valid_from, valid_to, CAST(place AS INTEGER) AS depth
        FROM (SELECT *, row_number() OVER newest AS place, sum(gap) OVER newest AS gaps,
                     bool_or(is_current AND segment = 'VIP') OVER (PARTITION BY customer_id) AS wanted
              FROM (SELECT *, CASE WHEN is_current OR valid_to = lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from)
                                   THEN 0 ELSE 1 END AS gap FROM v_dim)
              WINDOW newest AS (PARTITION BY customer_id ORDER BY valid_from DESC))
        WHERE wanted AND gaps = 0 AND place <= 20""",
    "as_of_read": """
        SELECT customer_id, segment, valid_from, valid_to FROM v_dim
        WHERE valid_from <= TIMESTAMP '1999-06-01 00:00:00' AND (valid_to IS NULL OR TIMESTAMP '1999-06-01 00:00:00' < valid_to)""",
    "customer_360": """
        SELECT customer_id, snapshot_date, total_spend_30d, order_count_30d, last_order_ts, top_category, traits FROM v_c360""",
    "hll_rollup": f"""
        SELECT CAST(order_ts AS DATE) AS snapshot_date, count(DISTINCT order_id) AS distinct_sessions_total FROM v_orders
        WHERE CAST(order_ts AS DATE) BETWEEN CAST({AS_OF_ORDERS} AS DATE) - 30 AND CAST({AS_OF_ORDERS} AS DATE) GROUP BY 1""",
}
