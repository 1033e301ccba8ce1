from checks.views import AS_OF_ORDERS

PROFILED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

_LOADED = """
    SELECT order_id, customer_id, order_ts, CASE WHEN order_id % 11 = 4 THEN NULL ELSE order_status END AS order_status,
           CASE WHEN order_id % 13 = 5 THEN NULL ELSE total_amount END AS total_amount
    FROM v_bronze WHERE order_id % 100 <> 3"""

SQL = {
    "load_csv": _LOADED,
    "load_json": """
        SELECT event_id, user_id, date_trunc('millisecond', event_ts) AS event_ts, left(event_type, 6) AS event_type
        FROM v_user_events WHERE event_id % 997 <> 3 OR event_id >= 50000""",
    "load_json_array": """
        SELECT event_id, user_id, date_trunc('millisecond', event_ts) AS event_ts, event_type FROM v_user_events""",
    "filename_date": "SELECT event_id, user_id, CAST(event_ts AS DATE) AS file_date FROM v_user_events",
    "unload_parquet": """
        SELECT event_date, count(*) AS n
        FROM (SELECT CAST(event_ts AS DATE) AS event_date, user_id FROM v_user_events GROUP BY ALL) GROUP BY event_date""",
    "load_audit": f"""
        SELECT CAST(order_id % 2 AS INTEGER) AS arrival, TIMESTAMP '2024-05-01 00:00:00' + to_hours(CAST(order_id % 2 * 20 AS INTEGER)) AS load_time,
               count_if(order_id % 100 <> 3)::BIGINT AS row_count, count(*) AS row_parsed, order_id % 2 = 1 AS last_day,
               count_if(order_id % 100 = 3) > 0 AS has_errors, (SELECT count(*) FROM ({_LOADED})) AS table_rows
        FROM v_bronze GROUP BY order_id % 2""",
    "load_manifest": """
        SELECT event_id, user_id, date_trunc('millisecond', event_ts) AS event_ts, event_type FROM v_user_events WHERE event_id % 3 <> 1""",
    "table_profile": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count, true AS has_bytes FROM {t}" for t in PROFILED),
    "stream_silver": "SELECT order_id, order_status, total_amount, is_high_value, is_deleted FROM v_silver",
    "rebuild_report": f"""
        WITH d AS (SELECT CAST(unnest(generate_series({AS_OF_ORDERS} - INTERVAL 60 DAY, {AS_OF_ORDERS}, INTERVAL 1 DAY)) AS DATE) AS order_date),
        n AS (SELECT CAST(order_ts AS DATE) AS order_date, count(*) AS row_count, count(e) AS error_count, min(e) AS first_error
              FROM (SELECT order_ts, CASE WHEN customer_id <= 0 THEN 'UNKNOWN_CUSTOMER' WHEN total_amount IS NULL THEN 'NO_AMOUNT' END AS e
                    FROM v_bronze2) GROUP BY 1),
        o AS (SELECT CAST(order_ts AS DATE) AS order_date, count(*) AS row_count FROM v_bronze1 GROUP BY 1),
        r AS (SELECT order_date, coalesce(n.row_count, 0) AS row_count, coalesce(error_count, 0) AS error_count, first_error,
                     coalesce(error_count, 0) = 0 AS published,
                     CASE WHEN coalesce(error_count, 0) = 0 THEN coalesce(n.row_count, 0) ELSE coalesce(o.row_count, 0) END AS rows_now
              FROM d LEFT JOIN n USING (order_date) LEFT JOIN o USING (order_date))
        SELECT *, CASE WHEN (SELECT bool_and(published) FROM r) THEN 'OK' WHEN (SELECT bool_or(published) FROM r) THEN 'PARTIAL_FAILURE' ELSE 'ERROR' END AS status,
               (SELECT sum(row_count)::BIGINT FROM r WHERE published) AS rows_inserted, (SELECT sum(error_count)::BIGINT FROM r) AS rows_rejected
        FROM r""",
    "customer_360_refresh": """
        SELECT customer_id, snapshot_date, total_spend_30d, order_count_30d, top_category, traits, true AS scored FROM v_c360
        UNION ALL SELECT customer_id, snapshot_date, total_spend_30d, order_count_30d, top_category, traits, false FROM v_c360_earlier""",
    "customer_360_runs": """
        SELECT 'c360-' || n AS run_id, 'customer_360_refresh' AS proc_name, 'OK' AS status, count(*) AS rows_processed,
               count_if(customer_id % 2 = 1 AND n = 1)::BIGINT AS rows_inserted, count_if(customer_id % 2 = 0 AND n = 1)::BIGINT AS rows_updated,
               CAST(0 AS BIGINT) AS rows_rejected
        FROM v_c360, (VALUES (1), (2)) t(n) GROUP BY n""",
    "channel_quantiles": """
        SELECT channel, count(total_amount) AS amount_count, true AS median_close, true AS p95_close FROM v_orders GROUP BY channel""",
    "approx_channel": """
        SELECT channel, count(DISTINCT customer_id) AS customers, true AS approx_customers_close, true AS approx_median_close,
               true AS approx_p95_close FROM v_orders GROUP BY channel""",
    "auto_ingest": f"SELECT order_id, order_status, total_amount FROM ({_LOADED})",
    "append_feed": "SELECT order_id, order_status, total_amount FROM v_bronze",
    "stream_sessions": """
        SELECT user_id, date_trunc('second', session_start) AS session_start, date_trunc('second', session_end) AS session_end, event_count
        FROM v_sessions
        WHERE date_trunc('second', session_end) + INTERVAL 6 HOUR
              <= (SELECT date_trunc('second', max(ts)) - INTERVAL 10 MINUTE FROM events)""",
    "all_stream_sessions": """
        SELECT user_id, date_trunc('second', session_start) AS session_start, date_trunc('second', session_end) AS session_end, event_count,
               date_trunc('second', session_end) + INTERVAL 6 HOUR
                 > (SELECT date_trunc('second', max(ts)) - INTERVAL 10 MINUTE FROM events) AS is_open
        FROM v_sessions""",
    "rebuild_partitions": f"""
        SELECT CAST(order_ts AS DATE) AS order_date, count(*) AS n
        FROM (SELECT order_ts FROM v_bronze1 WHERE order_ts < {AS_OF_ORDERS} - INTERVAL 60 DAY
              UNION ALL SELECT order_ts FROM v_bronze2 WHERE order_ts >= {AS_OF_ORDERS} - INTERVAL 60 DAY) GROUP BY 1""",
    "run_audit": """
        SELECT 'silver-1' AS run_id, 'silver_merge' AS proc_name, 'OK' AS status, count(*) AS rows_processed,
               count_if(action = 'INSERT' AND NOT is_update)::BIGINT AS rows_inserted,
               count_if(action = 'DELETE' OR is_update)::BIGINT AS rows_updated, CAST(0 AS BIGINT) AS rows_rejected
        FROM v_feed WHERE NOT (action = 'DELETE' AND is_update)""",
    "dwh_refresh": """
        SELECT 'dwh-1' AS run_id, 'refresh_dwh' AS proc_name, 'OK' AS status,
               (SELECT count(*) FROM v_fact_source WHERE action = 'INSERT' OR order_id IN (SELECT order_id FROM v_fact0))
                   AS rows_processed,
               (SELECT count(*) FROM v_dim_new) AS rows_inserted, (SELECT count(*) FROM v_dim_expired) AS rows_updated,
               (SELECT count(*) FROM v_feed f WHERE action = 'INSERT'
                  AND f.customer_id NOT IN (SELECT customer_id FROM v_dim WHERE is_current)) AS rows_rejected""",
}
