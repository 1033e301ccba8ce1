from checks.views import AS_OF_EVENTS, AS_OF_ORDERS

SQL = {
    "json_typed": """
        SELECT event_id, type AS event_type, user_id, country, event_ts, order_total, item_count
        FROM v_raw_events WHERE NOT broken AND type IN ('purchase', 'page_view')""",
    "json_items": """
        SELECT i.event_id, i.idx AS item_idx, e.user_id, i.sku, CAST(i.qty AS DECIMAL(18,0)) AS qty, i.unit_price,
               CAST(i.qty * i.unit_price AS DECIMAL(28,2)) AS line_total
        FROM v_raw_items i JOIN v_raw_events e USING (event_id)""",
    "json_purchases": """
        SELECT i.event_id, e.received_ts, e.user_id, e.country, e.order_id, e.order_total, i.sku,
               CAST(i.qty AS DECIMAL(18,0)) AS qty, i.unit_price
        FROM v_raw_items i JOIN v_raw_events e USING (event_id)""",
    "json_profiles": """
        SELECT user_id, first_event, last_event, types,
               '{"user_id":"' || user_id || '","country":"' || country || '","first_event":"' || first_event
               || '","last_event":"' || last_event || '","types":["' || replace(types, ',', '","') || '"]}' AS profile
        FROM (SELECT user_id, min(country) AS country, strftime(min(event_ts), '%Y-%m-%dT%H:%M:%SZ') AS first_event,
                     strftime(max(event_ts), '%Y-%m-%dT%H:%M:%SZ') AS last_event,
                     string_agg(DISTINCT type, ',' ORDER BY type) AS types
              FROM v_raw_events WHERE NOT broken GROUP BY user_id)""",
    "json_corrupt": "SELECT event_id, broken AS is_corrupt FROM v_raw_events",
    "json_keys": """
        SELECT event_id, 'type' AS key_name, type AS key_value FROM v_raw_events WHERE NOT broken
        UNION ALL SELECT event_id, 'ts', strftime(event_ts, '%Y-%m-%dT%H:%M:%SZ') FROM v_raw_events WHERE NOT broken
        UNION ALL SELECT event_id, 'user', '{"country":"' || country || '","id":' || user_id || '}' FROM v_raw_events WHERE NOT broken
        UNION ALL SELECT event_id, 'raw_log', 'k=' || event_id || ', src = ' || type || ',bad,x=1=2' FROM v_raw_events WHERE NOT broken
        UNION ALL SELECT e.event_id, 'order', '{"id":"' || any_value(e.order_id) || '","items":[' ||
                  string_agg('{"price":' || CAST(CAST(unit_price AS DOUBLE) AS VARCHAR).regexp_replace('\\.0$', '') || ',"qty":' || CAST(qty AS BIGINT)
                             || ',"sku":"' || sku || '"}', ',' ORDER BY idx)
                  || '],"total":' || CAST(any_value(e.raw_value) AS VARCHAR).regexp_replace('\\.0$', '') || '}'
                  FROM v_raw_events e JOIN v_raw_items i USING (event_id) GROUP BY e.event_id""",
    "split_kv": """
        SELECT event_id, 'k' AS k, CAST(event_id AS VARCHAR) AS v FROM v_raw_events WHERE NOT broken
        UNION ALL SELECT event_id, 'src', type FROM v_raw_events WHERE NOT broken
        UNION ALL SELECT event_id, 'x', '1=2' FROM v_raw_events WHERE NOT broken""",
    "topk_carts": f"""
        SELECT event_id, CAST(n AS INTEGER) AS idx, user_id, event_ts, 'P' || ((event_id * 7 + n + 1) % 1000) AS product_id,
               CAST((event_id + n + 1) % 5 + 1 AS INTEGER) AS quantity, price AS price_value, 'USD' AS price_ccy, campaign_id
        FROM (SELECT *, CAST((event_id * 37 + (n + 1) * 11) % 20000 / 100.0 AS DECIMAL(12,2)) AS price
              FROM v_user_events, (SELECT unnest([0, 1, 2]) AS n) WHERE n <= event_id % 3)
        WHERE event_type = 'CART_VIEWED' AND event_ts >= {AS_OF_EVENTS} - INTERVAL 7 DAY AND price > 50.00
        ORDER BY event_ts DESC, event_id, idx LIMIT 5000""",
    "order_payloads": "SELECT order_id, CAST(0 AS BIGINT) AS part_no, line_count, payload FROM v_payloads",
    "daily_user_metrics": f"""
        SELECT CAST(event_ts AS DATE) AS event_date, user_id, count(*) AS event_count,
               count(DISTINCT event_type) AS distinct_event_types, min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts
        FROM v_user_events WHERE event_ts >= {AS_OF_EVENTS} - INTERVAL 90 DAY GROUP BY 1, 2""",
    "sessionise": "SELECT event_id, user_id, event_ts, is_session_start, session_no FROM v_sessionised",
    "session_metrics": """
        SELECT user_id, session_no, session_start, session_end, duration_s, event_count, gmv,
               coalesce((SELECT class FROM v_amount_classes WHERE gmv BETWEEN low AND high), 'whale') AS gmv_bucket,
               utm_sources, median_lat, median_lon, device_type, country
        FROM v_sessions""",
    "session_p95": """
        SELECT user_id, session_no, country, duration_s, p95_duration_country
        FROM (SELECT *, round(quantile_cont(duration_s, 0.95) OVER (PARTITION BY country), 6) AS p95_duration_country,
                     row_number() OVER (PARTITION BY user_id ORDER BY session_start DESC, session_no DESC) AS rn
              FROM v_sessions WHERE duration_s > 0)
        WHERE rn <= 100""",
    "enriched_events": """
        SELECT e.event_id, e.user_id, e.event_ts, e.event_type, s.session_id,
               CASE WHEN regexp_full_match(lower(trim(s.user_email)), '[^@\\s]+@[^@\\s]+\\.[^@\\s]+') THEN lower(trim(s.user_email)) END
                   AS clean_email,
               e.event_type AS page
        FROM v_user_events e LEFT JOIN v_session_lookup s
          ON s.user_id = e.user_id AND e.event_ts BETWEEN s.session_start AND s.session_end""",
    "state_path": """
        SELECT customer_id, free_ts, trial_ts, event_ts AS paid_ts
        FROM (SELECT user_id AS customer_id, ts AS event_ts, event_type AS s0,
                     lag(event_type, 1) OVER w AS s1, lag(event_type, 2) OVER w AS s2,
                     lag(ts, 1) OVER w AS trial_ts, lag(ts, 2) OVER w AS free_ts
              FROM events WHERE event_type IN ('signup', 'click', 'purchase')
              WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
        WHERE s2 = 'signup' AND s1 = 'click' AND s0 = 'purchase'
          AND date_diff('day', free_ts, trial_ts) <= 30 AND date_diff('day', trial_ts, event_ts) <= 14""",
    "secure_customers": """
        WITH seen AS (
            SELECT role, sees_clear, customer_id, email, country FROM v_roles, v_customers WHERE sees_all
            UNION
            SELECT role, sees_clear, customer_id, email, c.country FROM v_roles JOIN v_role_map m ON m.role_name = role JOIN v_customers c ON c.country = m.country)
        SELECT role, customer_id, country, if(sees_clear, email, regexp_replace(email, '(.)(.*)(@.*)', '\\1***\\3')) AS email FROM seen""",
    "pii_projection": """
        SELECT customer_id, base64(encode(email)) AS email_b64, sha256(lower(email)) AS email_hash FROM v_customers""",
    "order_risk": f"""
        SELECT o.order_id, CASE WHEN strpos(c.email, '@') > 0 THEN lower(substr(c.email, strpos(c.email, '@') + 1)) END AS email_domain,
               CASE WHEN total_amount IS NULL THEN 'unknown'
                    ELSE coalesce((SELECT class FROM v_amount_classes WHERE total_amount BETWEEN low AND high), 'whale') END AS amt_bucket,
               CASE WHEN length(card_pan) >= 4 THEN repeat('*', length(card_pan) - 4) || right(card_pan, 4) END AS masked_pan,
               CAST(least(1.0, greatest(0.0, CAST(0.001 * round(total_amount, 0) AS DECIMAL(18,3))
                    + CASE channel WHEN 'WEB' THEN 0.20 WHEN 'CALLCENTER' THEN 0.10 ELSE 0.05 END
                    + CASE c.country WHEN 'US' THEN 0.00 WHEN 'IN' THEN 0.05 ELSE 0.15 END)) AS DECIMAL(6,4)) AS fraud_score
        FROM v_orders o JOIN v_customers c USING (customer_id)
        WHERE o.order_ts >= {AS_OF_ORDERS} - INTERVAL 30 DAY""",
    "customer_audit_log": f"""
        SELECT customer_id, unnest([TIMESTAMP '2000-01-01 00:00:00', {AS_OF_ORDERS}]) AS audited_at FROM v_customers WHERE is_active""",
}
