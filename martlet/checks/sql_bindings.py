"""The input tables as SQL, for the check engine. Must stay equal to ``bindings``."""

from __future__ import annotations

import re

_EMAIL = """CASE WHEN c_custkey % 50 = 0 THEN 'ab@x.com'
                 ELSE lower(replace(c_name, '#', '.')) || '@example.com' END"""

BLOCKS = {
    "raw_sales": """
        SELECT l_orderkey AS transaction_id, o_custkey AS customer_id, l_partkey AS product_id,
               CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INT) AS quantity,
               CAST(CASE WHEN l_partkey % 50 = 0 THEN 0.0 ELSE p_retailprice END AS DECIMAL(10,2)) AS unit_price,
               l_suppkey AS store_id,
               o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR AS transaction_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "sales": "SELECT * FROM raw_sales WHERE quantity > 0 AND unit_price > 0",
    "products": """
        SELECT p_partkey AS product_id, p_name AS description,
               CAST(p_retailprice AS DECIMAL(10,2)) AS base_price, p_type AS category,
               'SUP_' || CAST(100 + p_partkey % 900 AS VARCHAR) AS supplier_id
        FROM part""",
    "brands": "SELECT p_partkey AS product_id, p_brand AS description FROM part",
    "stores": """
        SELECT s_suppkey AS store_id, s_name AS store_name, n_name AS city
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "first_customers": f"""
        SELECT c_custkey AS customer_id, c_name AS name, {_EMAIL} AS email, n_name AS city,
               CAST(DATE '2024-01-01' + CAST(c_custkey % 150 AS INT) AS TIMESTAMP) AS update_timestamp
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "moved_customers": f"""
        SELECT c_custkey AS customer_id, c_name AS name, {_EMAIL} AS email,
               'NATION_' || CAST((c_nationkey + 7) % 25 AS VARCHAR) AS city,
               CAST(DATE '2024-07-01' + CAST(c_custkey % 10 AS INT) AS TIMESTAMP) AS update_timestamp
        FROM customer WHERE c_custkey % 3 = 0""",
    "odd_customers": """
        SELECT customer_id, name, email, 'ODDTOWN' AS city,
               CASE WHEN customer_id % 30 = 4 THEN update_timestamp END AS update_timestamp
        FROM first_customers WHERE customer_id % 30 IN (4, 5)""",
    "raw_customers": """
        SELECT * FROM first_customers UNION ALL SELECT * FROM moved_customers
        UNION ALL SELECT * FROM odd_customers""",
    "customers": """
        SELECT *, update_timestamp = max(update_timestamp) OVER (PARTITION BY customer_id) AS is_current,
               update_timestamp AS valid_from
        FROM raw_customers""",
    "customer_history": """
        SELECT * REPLACE (update_timestamp - INTERVAL 28 YEARS AS update_timestamp)
        FROM raw_customers""",
    "versions_in_order": """
        SELECT * FROM customer_history WHERE update_timestamp IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY customer_id, update_timestamp
                                   ORDER BY name DESC, email DESC, city DESC) = 1""",
    "customer_feed": """
        SELECT * FROM moved_customers
        UNION ALL SELECT customer_id, name, email, city, TIMESTAMP '2024-08-15 00:00:00'
        FROM moved_customers WHERE customer_id % 6 = 0
        UNION ALL SELECT customer_id, name, email, city, TIMESTAMP '2024-09-01 00:00:00'
        FROM first_customers WHERE customer_id % 9 = 0
        UNION ALL SELECT customer_id, name, email, city, TIMESTAMP '2024-08-01 00:00:00'
        FROM first_customers WHERE customer_id % 20 = 1
        UNION ALL SELECT customer_id, name, email, 'LATE', TIMESTAMP '2023-06-01 00:00:00'
        FROM first_customers WHERE customer_id % 20 = 2
        UNION ALL SELECT * FROM odd_customers""",
    "raw_inventory": """
        SELECT DISTINCT l_suppkey AS store_id, l_partkey AS product_id,
               CAST(((l_suppkey * 31 + l_partkey * 17) % 551) - 50 AS INT) AS stock_on_hand,
               DATE '2024-01-01' + CAST((l_suppkey + l_partkey) % 30 AS INT) AS last_restock_date
        FROM lineitem""",
    "inventory": """
        SELECT store_id, product_id, CASE WHEN stock_on_hand < 0 THEN 0 ELSE stock_on_hand END AS stock_on_hand,
               last_restock_date
        FROM raw_inventory""",
    "shipments": """
        SELECT 'SHP_' || CASE WHEN o_orderkey < 9999999 THEN lpad(CAST(o_orderkey + 1 AS VARCHAR), 7, '0')
                              ELSE CAST(o_orderkey + 1 AS VARCHAR) END AS shipment_id,
               o_orderkey AS transaction_id,
               CASE WHEN o_orderkey % 17 = 0 THEN 'Returned' WHEN o_orderstatus = 'F' THEN 'Delivered'
                    WHEN o_orderstatus = 'O' THEN 'Shipped' ELSE 'Processing' END AS status,
               CAST(1 + (o_orderkey * 5) % 14 AS INT) AS delivery_time_days,
               o_orderdate AS shipment_date
        FROM orders JOIN (SELECT DISTINCT l_orderkey FROM lineitem) t ON o_orderkey = l_orderkey""",
    "raw_web_events": """
        SELECT seq, event_id, 'sess_' || CAST(1000 + CAST(floor(event_id / 4) AS BIGINT) AS VARCHAR) AS session_id,
               CASE WHEN event_id % 83 = 0 THEN NULL ELSE user_id END AS customer_id,
               CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
                    WHEN 'purchase' THEN 'checkout_completed' WHEN 'signup' THEN 'checkout_start'
                    ELSE 'search' END AS event_type,
               ts AS "timestamp",
               CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
               CASE WHEN seq = 1 THEN 'newsletter' ELSE 'direct' END AS referrer,
               CASE WHEN event_type IN ('view','click','error') THEN (event_id * 13) % 2000 END AS product_id,
               CASE WHEN event_type = 'view' THEN CAST(10 + event_id % 291 AS INT) END AS duration_seconds,
               CASE event_id % 20 WHEN 0 THEN 'SAVE10' WHEN 1 THEN 'WELCOME20' WHEN 2 THEN 'FLASH35' END AS promo_code,
               CASE WHEN event_type = 'click' THEN CAST(1 + event_id % 5 AS INT) END AS quantity,
               CASE WHEN event_type = 'purchase' THEN 'TXN_' || CAST(100000 + event_id AS VARCHAR) END AS transaction_id,
               CASE WHEN event_type = 'purchase' THEN value END AS total_value
        FROM (SELECT e.*, 0 AS seq FROM events e
              UNION ALL SELECT e.*, 1 AS seq FROM events e WHERE event_id % 60 = 0
              UNION ALL SELECT e.* REPLACE (ts + INTERVAL 250 MILLISECONDS AS ts), 3 AS seq
              FROM events e WHERE event_id % 70 = 5) x""",
    "web_texts": """
        SELECT * EXCLUDE (duration_seconds),
               CASE WHEN event_id % 41 <> 2 THEN duration_seconds END AS duration_seconds,
               duration_seconds IS NOT NULL AND event_id % 41 = 2 AS unfit,
               CASE event_id % 97
                    WHEN 13 THEN 'yesterday'
                    WHEN 14 THEN replace(CAST("timestamp" AS VARCHAR), ' ', 'T') || 'Z'
                    WHEN 15 THEN '2024'
                    WHEN 16 THEN CAST(CAST("timestamp" AS DATE) AS VARCHAR)
                    ELSE replace(CAST("timestamp" AS VARCHAR), ' ', 'T') END AS time_text,
               CASE WHEN event_id % 97 IN (13, 14, 15) THEN NULL
                    WHEN event_id % 97 = 16 THEN date_trunc('day', "timestamp")
                    ELSE "timestamp" END AS read_at
        FROM raw_web_events""",
    "web_events": """
        SELECT * EXCLUDE (rn), CAST("timestamp" AS DATE) AS event_date
        FROM (SELECT *, row_number() OVER (PARTITION BY session_id, event_type, "timestamp"
                                           ORDER BY seq, event_id) AS rn
              FROM raw_web_events WHERE customer_id IS NOT NULL) x
        WHERE rn = 1""",
    "visits": """
        SELECT customer_id, min("timestamp") AS started, max("timestamp") AS ended, count(*) AS events,
               count(*) FILTER (WHERE event_type = 'page_view') AS page_view,
               count(*) FILTER (WHERE event_type = 'add_to_cart') AS add_to_cart,
               count(*) FILTER (WHERE event_type = 'checkout_start') AS checkout_start,
               count(*) FILTER (WHERE event_type = 'checkout_completed') AS checkout_completed,
               coalesce(sum(total_value) FILTER (WHERE event_type = 'checkout_completed'), 0) AS revenue
        FROM (SELECT *, count(*) FILTER (WHERE fresh) OVER (
                  PARTITION BY customer_id ORDER BY "timestamp", event_id, seq
                  ROWS UNBOUNDED PRECEDING) AS visit
              FROM (SELECT *, coalesce("timestamp" - lag("timestamp") OVER (
                        PARTITION BY customer_id ORDER BY "timestamp", event_id, seq)
                        > INTERVAL 6 HOURS, true) AS fresh
                    FROM web_events) x) y
        GROUP BY customer_id, visit""",
    "live_ticks": """
        SELECT ts AS tick_ts, CAST(100 + (event_id * 37) % 901 AS INT) AS sales,
               CAST(10 + event_id % 41 AS INT) AS inventory,
               'ST_' || lpad(CAST(1 + event_id % 5 AS VARCHAR), 3, '0') AS store_id
        FROM events""",
    "raw_retail": """
        SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS invoice_no,
               CAST(l_partkey AS VARCHAR) AS stock_code,
               CASE WHEN l_partkey % 40 = 0 THEN NULL ELSE '  ' || upper(p_name) || ' ' END AS description,
               CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INT) AS quantity,
               o_orderdate AS invoice_date,
               CAST(CASE WHEN l_partkey % 50 = 0 THEN 0.0 ELSE p_retailprice END AS DECIMAL(10,2)) AS unit_price,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey END AS customer_id,
               n_name AS country, l_linenumber AS line_no
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
}


def with_tables(query: str, extra: dict[str, str] | None = None) -> str:
    """``query`` behind a WITH clause of the tables it names, directly or not, in order."""
    blocks = {**BLOCKS, **(extra or {})}
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in blocks:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(blocks[name])

    visit(query)
    clauses = [f"{name} AS ({blocks[name].strip()})" for name in blocks if name in needed]
    return ("WITH " + ",\n".join(clauses) + "\n" if clauses else "") + query.strip()
