"""The same queries as SQL, for the engine that checks the results."""

from __future__ import annotations

import re

from martlet.checks.bindings import END, START
from martlet.checks.registry import DELTA, MIN_SUPPORT, RETENTION_DAY, RUN_TS, WATERMARK
from martlet.checks.sql_bindings import with_tables

# Fixed values, written down a second time so that a wrong one on either side shows.
KEYWORDS = [("ring", "Jewellery"), ("bolt", "Hardware"), ("gear", "Hardware"), ("gizmo", "Toys")]
SUPPLIERS = [
    ("Jewellery", "SUP001"), ("Hardware", "SUP002"), ("Toys", "SUP003"), ("Other", "SUP004")
]
CITIES = [
    ("NATION_0", "Mumbai"), ("NATION_1", "Delhi"), ("NATION_2", "Ahmedabad"), ("NATION_3", "Pune")
]
DOCUMENTED_STATES = "'Delivered', 'In Transit', 'Processing', 'Delayed'"
CONSTRAINTS = """
    dim_customers: key customer_id; not_null name, city, update_timestamp; unique email;
        max_length customer_id 10, name 100, email 150, city 100
    dim_products: key product_id; not_null description, base_price, category, supplier_id;
        check base_price > 0;
        max_length product_id 10, description 500, category 100, supplier_id 10
    dim_stores: key store_id; not_null store_name, city; max_length store_id 10, store_name 100, city 100
    fact_sales: key transaction_id;
        not_null customer_id, product_id, quantity, unit_price, store_id, transaction_date;
        check quantity > 0, unit_price > 0;
        max_length transaction_id 20, customer_id 10, product_id 10, store_id 10;
        reference customer_id dim_customers, product_id dim_products, store_id dim_stores
    fact_inventory: key store_id+product_id; not_null stock_on_hand, last_restock_date;
        check stock_on_hand >= 0; reference store_id dim_stores, product_id dim_products
    fact_shipments: key shipment_id;
        not_null transaction_id, status, delivery_time_days, shipment_date;
        check delivery_time_days >= 0; max_length shipment_id 20, transaction_id 20, status 50;
        reference transaction_id fact_sales
"""

PERIOD = f"transaction_date BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"
REVENUE = "CAST(SUM(quantity * unit_price) AS DOUBLE)"
MEAN_LINE = "CAST(SUM(quantity * unit_price) AS DOUBLE) / COUNT(*)"
SALE = (
    "transaction_id, customer_id, product_id, quantity, "
    "CAST(unit_price AS DOUBLE) AS unit_price, store_id, transaction_date"
)
EVENT = (
    'session_id, customer_id, event_type, "timestamp", device_type, referrer, product_id, '
    "duration_seconds, promo_code, quantity, transaction_id, total_value"
)
EVENT_TEXT = EVENT.replace("product_id", "CAST(product_id AS VARCHAR) AS product_id")
RETAIL = (
    "invoice_no, stock_code, description, quantity, invoice_date, "
    "CAST(unit_price AS DOUBLE) AS unit_price, customer_id, country, line_no"
)

# What the tables of the star schema are called here.
STAR = {
    "dim_customers": "customers",
    "dim_products": "products",
    "dim_stores": "stores",
    "fact_sales": "sales",
    "fact_inventory": "inventory",
    "fact_shipments": "shipments",
    "fact_web_events": "web_events",
}
RAW_VIEW_SOURCES = {
    "raw_customers": "customers",
    "raw_products": "products",
    "raw_stores": "stores",
    "raw_sales": "sales",
    "raw_inventory": "inventory",
    "raw_web_events": "web_events",
}
GOLD_VIEW_SOURCES = {
    "secure_customers": "customers",
    "analytics_sales_performance": "sales",
    "analytics_web_engagement": "web_events",
}


def _counts(sources: dict[str, str], more: str = "") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count{more} FROM {table}"
        for name, table in sources.items()
    )


def _cases(pairs: list[tuple[str, str]], test: str, default: str) -> str:
    whens = " ".join(f"WHEN {test.format(k)} THEN '{v}'" for k, v in pairs)
    return f"CASE {whens} ELSE {default} END"


def _declared() -> list[tuple[str, str, list[str], str]]:
    """(table, kind, columns, detail) of each constraint listed above."""
    found, text = [], " ".join(CONSTRAINTS.split())
    for table, rules in re.findall(r"(\w+): (.*?)(?= \w+:|$)", text):
        for group in rules.split(";"):
            kind, _, members = group.strip().partition(" ")
            for member in members.split(","):
                columns, _, detail = member.strip().partition(" ")
                found.append((table, kind, columns.split("+"), detail))
    return found


def _violations(table: str, kind: str, columns: list[str], detail: str) -> str:
    """One row per rule, written as the plain count of the rows that break it."""
    source, column, keys = CONSTRAINED[table], columns[0], ", ".join(columns)
    known = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    extra = f"""(SELECT COALESCE(SUM(n - 1), 0) FROM
                 (SELECT COUNT(*) AS n FROM {source} WHERE {known} GROUP BY {keys}) g)"""
    count = {
        "not_null": lambda: f"(SELECT COUNT(*) FROM {source} WHERE {column} IS NULL)",
        "check": lambda: f"(SELECT COUNT(*) FROM {source} WHERE NOT ({column} {detail}))",
        "max_length": lambda: f"""(SELECT COUNT(*) FROM {source}
                                  WHERE length(CAST({column} AS VARCHAR)) > {detail})""",
        "unique": lambda: extra,
        "key": lambda: f"{extra} + (SELECT COUNT(*) FROM {source} WHERE NOT ({known}))",
        "reference": lambda: f"""(SELECT COUNT(*) FROM {source} f WHERE f.{column} IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM {CONSTRAINED[detail]} d WHERE d.{column} = f.{column}))""",
    }[kind]()
    name = f"{kind}({keys})" + (f" {detail}" if detail else "")
    return (
        f"SELECT '{table}' AS table_name, '{name}' AS rule, CAST({count} AS BIGINT) AS violations"
    )


CONSTRAINED = {**STAR, "fact_sales": "raw_sales", "dim_customers": "raw_customers"}


def _constraint_sql() -> str:
    return "\nUNION ALL\n".join(_violations(*rule) for rule in _declared())


def _quality_sql() -> str:
    kept = "(SELECT * FROM web_texts WHERE customer_id IS NOT NULL) k"
    first = f"(SELECT DISTINCT session_id, event_type, time_text, read_at FROM {kept}) f"
    optional = " OR ".join(
        f"{c} IS NULL"
        for c in ("product_id", "duration_seconds", "promo_code", "quantity", "transaction_id")
    )
    rows = [
        ("dim_customers", "duplicate customer_id", "flag history", "customers WHERE NOT is_current"),
        ("fact_sales", "quantity <= 0", "drop row", "raw_sales WHERE quantity <= 0"),
        ("fact_sales", "unit_price <= 0", "drop row", "raw_sales WHERE unit_price <= 0"),
        (
            "fact_sales",
            "all rules",
            "drop row",
            "raw_sales WHERE NOT (quantity > 0 AND unit_price > 0)",
        ),
        ("fact_inventory", "stock_on_hand < 0", "floor to 0", "raw_inventory WHERE stock_on_hand < 0"),
        (
            "fact_web_events",
            "customer_id is null",
            "drop row",
            "raw_web_events WHERE customer_id IS NULL",
        ),
        (
            "fact_web_events",
            "duplicate event",
            "keep first",
            f"""(SELECT row_number() OVER (PARTITION BY session_id, event_type, time_text) AS rn
                 FROM {kept}) d WHERE rn > 1""",
        ),
        ("fact_web_events", "invalid timestamp", "quarantine", f"{first} WHERE read_at IS NULL"),
        ("fact_web_events", "missing optional field", "set to null", f"{kept} WHERE {optional}"),
        (
            "fact_web_events",
            "JSON parse error",
            "skip line",
            "raw_web_events WHERE seq = 0 AND event_id % 100 IN (1, 2, 4, 5, 6)",
        ),
        ("fact_web_events", "value does not fit", "set to null", "web_texts WHERE unfit"),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT '{source}' AS source, '{check}' AS \"check\", '{action}' AS action, "
        f"COUNT(*) AS affected FROM {rest}"
        for source, check, action, rest in rows
    )


def _city(current: str) -> str:
    return f"""
        SELECT c.city, CAST(SUM(s.quantity * s.unit_price) AS DOUBLE) AS revenue
        FROM sales s JOIN customers c ON s.customer_id = c.customer_id
        WHERE s.{PERIOD} {current}
        GROUP BY 1 ORDER BY SUM(s.quantity * s.unit_price) DESC, 1 LIMIT 10"""


def _top(order: str, n: int) -> str:
    return f"""
        SELECT p.description AS product_name, CAST(SUM(s.quantity) AS BIGINT) AS units_sold,
               CAST(SUM(s.quantity * s.unit_price) AS DOUBLE) AS revenue
        FROM sales s JOIN products p ON s.product_id = p.product_id
        WHERE s.{PERIOD} AND s.quantity > 0
        GROUP BY 1 ORDER BY {order} DESC, 1 LIMIT {n}"""


def _clv(current: str) -> str:
    return f"""
        SELECT name, spent / n_lines * n_orders * 1.5 AS clv_score
        FROM customers c JOIN (
            SELECT customer_id AS buyer, CAST(SUM(quantity * unit_price) AS DOUBLE) AS spent,
                   COUNT(*) AS n_lines, COUNT(DISTINCT transaction_id) AS n_orders
            FROM sales WHERE {PERIOD} GROUP BY ALL
        ) totals ON buyer = c.customer_id {current}
        ORDER BY 2 DESC, 1 LIMIT 8"""


def _secure(email: str) -> str:
    return f"""
        SELECT customer_id, name, city, update_timestamp, is_current, {email} AS email,
               'MASKED' AS privacy_status
        FROM customers"""


MASK = r"regexp_replace(email, '(^.{3})(.*)(@.*$)', '\1****\3')"



def _sets_of(size: int) -> str:
    """Frequent sets of one size by self-joins of the lines of a basket."""
    names = [f"l{k}" for k in range(size)]
    joins = "".join(
        f" JOIN lines {b} ON {a}.t = {b}.t AND {a}.i < {b}.i"
        for a, b in zip(names, names[1:], strict=False)
    )
    items = ", ".join(f"{name}.i" for name in names)
    return f"""
        SELECT [{items}] AS items, COUNT(*) AS freq FROM lines l0{joins} GROUP BY {items}
        HAVING COUNT(*) / (SELECT n FROM total) >= {MIN_SUPPORT}"""


# Market basket. The given tables have no frequent set of more than four brands.
MERGED = {
    "merge_records": """
        SELECT customer_id, name, email, city, update_timestamp, MIN(source) AS source
        FROM (SELECT *, 0 AS source FROM first_customers UNION ALL SELECT *, 1 FROM customer_feed) r
        GROUP BY ALL""",
    "merge_numbered": """
        SELECT *, row_number() OVER (PARTITION BY customer_id
                      ORDER BY update_timestamp NULLS FIRST, source, name, email, city) AS n
        FROM merge_records""",
    # A fed record goes if the record before it says the same.
    "merged_versions": """
        SELECT r.customer_id, r.name, r.email, r.city, r.update_timestamp
        FROM merge_numbered r LEFT JOIN merge_numbered b ON b.customer_id = r.customer_id AND b.n = r.n - 1
        WHERE r.source = 0 OR b.n IS NULL OR (b.name, b.email, b.city) <> (r.name, r.email, r.city)""",
}

BASKET = {
    "lines": """
        SELECT DISTINCT s.transaction_id AS t, p.description AS i
        FROM sales s JOIN brands p ON s.product_id = p.product_id WHERE s.quantity > 0""",
    "total": "SELECT CAST(COUNT(DISTINCT t) AS DOUBLE) AS n FROM lines",
    "sets": "\nUNION ALL".join(_sets_of(size) for size in range(1, 6)),
    "rules": """
        SELECT array_to_string(a.items, ', ') AS antecedents,
               array_to_string(c.items, ', ') AS consequents,
               w.freq / n AS support, w.freq / CAST(a.freq AS DOUBLE) AS confidence,
               w.freq / CAST(a.freq AS DOUBLE) / (c.freq / n) AS lift,
               w.freq * n >= CAST(a.freq AS DOUBLE) * c.freq AS lifted
        FROM sets w JOIN sets a ON list_has_all(w.items, a.items) AND len(a.items) < len(w.items)
        JOIN sets c ON list_has_all(w.items, c.items) AND len(c.items) = len(w.items) - len(a.items)
         AND NOT list_has_any(a.items, c.items)
        JOIN total ON true""",
    "business": """
        SELECT *, round_even(support * 100, 1) AS buy_frequency,
               round_even(confidence * 100, 0) AS purchase_likelihood,
               round_even(lift, 1) AS strength_score,
               row_number() OVER (ORDER BY lift DESC, antecedents, consequents) AS rank
        FROM rules WHERE lifted
        QUALIFY rank <= 15""",
}
RULE_COLUMNS = """antecedents, consequents, ROUND(support, 9) AS support,
                  ROUND(confidence, 9) AS confidence, ROUND(lift, 9) AS lift"""
PERCENT = "CAST(CAST(purchase_likelihood AS INT) AS VARCHAR) || '%'"
STRENGTH = "CAST(strength_score AS VARCHAR) || 'x'"


# The wording of the recommendations.
RECOMMENDED = """
    SELECT 1 AS position, 'Store Layout' AS title,
           'Place **' || antecedents || '** near **' || consequents
           || '** to increase impulse purchases.' AS text FROM business WHERE rank = 1
    UNION ALL SELECT 2, 'Cross-Sell Promotions', 'Create a bundle offer: Buy **' || antecedents
           || '**, get a discount on **' || consequents || '**.' FROM business WHERE rank = 2
    UNION ALL SELECT 3, 'Email Marketing',
           'Send personalized recommendations to customers who bought **' || antecedents
           || '** suggesting **' || consequents || '**.' FROM business WHERE rank = 3
    UNION ALL SELECT 4, 'Inventory Planning', 'When stocking **' || antecedents
           || '**, ensure adequate inventory of **' || consequents || '**.' FROM business WHERE rank = 1"""


TITLE = """(SELECT string_agg(upper(w[1]) || lower(w[2:]), ' ')
            FROM (SELECT unnest(string_split(trim(description), ' ')) AS w) words)"""
FIRST_LINES = """
    SELECT stock_code AS product_id, first(description ORDER BY invoice_date, invoice_no, line_no) AS description,
           CAST(first(unit_price ORDER BY invoice_date, invoice_no, line_no) AS DOUBLE) AS base_price
    FROM raw_retail GROUP BY stock_code"""

_NO_NUMBERS = "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max"


def _numbers(column: str) -> str:
    value = f"CAST({column} AS DOUBLE)"
    return (
        f"ROUND(AVG({value}), 4) AS mean, ROUND(stddev_samp({value}), 4) AS stddev, "
        f"MIN({value}) AS min, MAX({value}) AS max"
    )


PLAIN: dict[str, str] = {
    "web_events_parse": f"SELECT {EVENT_TEXT} FROM web_texts".replace(
        '"timestamp",', 'time_text AS "timestamp",'
    ),
    "web_bad_lines": """
        SELECT CASE event_id % 100 WHEN 1 THEN 'bad{' WHEN 2 THEN '' WHEN 4 THEN '5'
                    WHEN 5 THEN '{"customer_id":1}{"customer_id":2}'
                    ELSE '{"customer_id":1} junk}' END AS value,
               COUNT(*) AS bad_lines
        FROM raw_web_events WHERE seq = 0 AND event_id % 100 IN (1, 2, 4, 5, 6) GROUP BY 1""",
    "web_events_schema": """
        SELECT event_id, seq, promo_code,
               CASE WHEN event_id % 40 = 7 THEN 'spring' END AS campaign,
               CASE WHEN event_id % 90 = 11 THEN 'variant_b' END AS ab_test
        FROM raw_web_events""",
    "web_new_fields": """
        SELECT DISTINCT 'campaign' AS field FROM events WHERE event_id % 40 = 7
        UNION ALL SELECT DISTINCT 'ab_test' FROM events WHERE event_id % 90 = 11""",
    "raw_views_count": _counts(RAW_VIEW_SOURCES),
    "quality_report": _quality_sql(),
    "retail_drop_null_customer": f"SELECT {RETAIL} FROM raw_retail WHERE customer_id IS NOT NULL",
    "derive_dim_products": FIRST_LINES,
    "derive_dim_customers": "SELECT DISTINCT customer_id FROM raw_retail WHERE customer_id IS NOT NULL",
    "derive_fact_sales": """
        SELECT invoice_no AS transaction_id, customer_id, stock_code AS product_id, quantity,
               CAST(unit_price AS DOUBLE) AS unit_price
        FROM raw_retail WHERE customer_id IS NOT NULL""",
    "derive_shipment_keys": """
        SELECT DISTINCT 'SHP_' || CASE WHEN transaction_id < 10000000
               THEN lpad(CAST(transaction_id AS VARCHAR), 7, '0')
               ELSE CAST(transaction_id AS VARCHAR) END AS shipment_id, transaction_id
        FROM raw_sales""",
    "derive_shipment_texts": """
        SELECT DISTINCT 'SHP_' || CASE WHEN other AND quantity % 3 = 0 THEN '#0' || id
                                       WHEN other AND quantity % 3 = 1 THEN 'C' || id
                                       WHEN length(id) < 7 THEN lpad(id, 7, '0') ELSE id END AS shipment_id,
               CASE WHEN other AND quantity % 3 = 0 THEN '0' WHEN other AND quantity % 3 = 1 THEN 'C'
                    ELSE '' END || id AS transaction_id
        FROM (SELECT CAST(transaction_id AS VARCHAR) AS id, transaction_id % 5 = 0 AS other, quantity
              FROM raw_sales) t""",
    "line_transaction_id": """
        SELECT 'TXN' || invoice_no || '-' || CAST(line_in_invoice AS VARCHAR) AS transaction_id,
               'CUST' || CAST(customer_id AS VARCHAR) AS customer_id,
               'PROD' || stock_code AS product_id, quantity,
               CAST(unit_price AS DOUBLE) AS unit_price, invoice_no, line_in_invoice
        FROM (SELECT *, row_number() OVER (PARTITION BY invoice_no
                                           ORDER BY line_no, stock_code, quantity) AS line_in_invoice
              FROM raw_retail) x""",
    "retail_clean": f"""
        SELECT {RETAIL} FROM raw_retail
        WHERE NOT starts_with(invoice_no, 'C') AND quantity > 0 AND customer_id IS NOT NULL
          AND unit_price > 0""",
    "standardize_description": f"""
        SELECT product_id, {TITLE} AS description, base_price
        FROM ({FIRST_LINES}) p WHERE trim(description) <> ''""",
    "categorize_products": f"""
        SELECT product_id, description, CAST(base_price AS DOUBLE) AS base_price, category,
               {_cases(SUPPLIERS, "category = '{}'", "NULL")} AS supplier_id
        FROM (SELECT product_id, description, base_price,
                     {_cases(KEYWORDS, "contains(lower(description), '{}')", "'Other'")} AS category
              FROM products) p""",
    "customer_enrich": f"""
        SELECT customer_id, replace(name, '#', ' ') AS name,
               lower(replace(replace(name, '#', ' '), ' ', '.')) || '@email.com' AS email,
               {_cases(CITIES, "city = '{}'", "city")} AS city,
               TIMESTAMP '{RUN_TS}' AS update_timestamp
        FROM first_customers""",
    "dedup_pk": f"""
        SELECT {SALE} FROM (
            SELECT *, row_number() OVER (PARTITION BY transaction_id, product_id
                ORDER BY quantity, store_id, customer_id, unit_price, transaction_date) AS rn
            FROM raw_sales) x
        WHERE rn = 1""",
    "customer_sample": f"""
        SELECT * FROM raw_customers
        WHERE substr(md5(CAST(customer_id AS VARCHAR)), 1, 8) < '{int(0.05 * 0x100000000):08x}'""",
    "scd2_customers": "SELECT * FROM customers",
    "scd2_history_count": "SELECT COUNT(*) AS historical_records FROM customers WHERE NOT is_current",
    "scd2_current": "SELECT * FROM customers WHERE is_current",
    "scd2_history": "SELECT * FROM customers ORDER BY customer_id, update_timestamp DESC",
    "scd2_versions": """
        SELECT customer_id, COUNT(*) AS versions FROM raw_customers
        GROUP BY customer_id HAVING COUNT(*) > 1""",
    "scd2_check": """
        SELECT COUNT(*) FILTER (is_current) AS current_rows, COUNT(DISTINCT customer_id) AS customers,
               COUNT(*) FILTER (is_current) = COUNT(DISTINCT customer_id) AS ok
        FROM customers""",
    "scd2_merge": """
        SELECT v.*, v.update_timestamp AS valid_from,
               (SELECT MIN(l.update_timestamp) FROM merged_versions l
                WHERE l.customer_id = v.customer_id AND l.update_timestamp > v.update_timestamp)
                   AS valid_to,
               v.update_timestamp = (SELECT MAX(l.update_timestamp) FROM merged_versions l
                                     WHERE l.customer_id = v.customer_id) AS is_current
        FROM merged_versions v""",
    "sales_clean": f"SELECT {SALE} FROM sales",
    "sales_dropped": """
        SELECT COUNT(*) AS initial_rows, COUNT(*) FILTER (quantity > 0 AND unit_price > 0) AS kept_rows,
               COUNT(*) FILTER (NOT (quantity > 0 AND unit_price > 0)) AS dropped_rows
        FROM raw_sales""",
    "sales_partition_keys": f"""
        SELECT {SALE}, CAST(year(transaction_date) AS INT) AS year,
               CAST(month(transaction_date) AS INT) AS month
        FROM sales""",
    "inventory_clean": "SELECT * FROM inventory",
    "web_null_customer": f"SELECT {EVENT} FROM raw_web_events WHERE customer_id IS NOT NULL",
    "web_dedup": f"""
        SELECT {EVENT} FROM (
            SELECT *, row_number() OVER (PARTITION BY session_id, event_type, "timestamp"
                                         ORDER BY seq, event_id) AS rn
            FROM raw_web_events) x
        WHERE rn = 1""",
    "web_dedup_second": f"""
        SELECT {EVENT} FROM (
            SELECT *, row_number() OVER (PARTITION BY session_id, event_type, date_trunc('second', "timestamp")
                                         ORDER BY seq, event_id) AS rn
            FROM raw_web_events) x
        WHERE rn = 1""",
    "web_event_date": """
        SELECT event_id, seq, session_id, read_at AS "timestamp", CAST(read_at AS DATE) AS event_date
        FROM web_texts""",
    "fact_web_events": f"""
        SELECT {EVENT_TEXT.replace('"timestamp"', 'read_at AS "timestamp"')},
               CAST(read_at AS DATE) AS event_date
        FROM (SELECT *, row_number() OVER (PARTITION BY session_id, event_type, time_text
                                           ORDER BY seq, event_id) AS rn
              FROM web_texts WHERE customer_id IS NOT NULL) x
        WHERE rn = 1 AND read_at IS NOT NULL""",
    "incremental_sales": f"""
        SELECT {SALE}, CAST(year(transaction_date) AS INT) AS year,
               CAST(month(transaction_date) AS INT) AS month
        FROM sales WHERE transaction_date > TIMESTAMP '{WATERMARK}'""",
    "web_retention": f"""
        SELECT {EVENT}, event_date FROM web_events
        WHERE NOT event_date < CAST(DATE '{RETENTION_DAY}' - INTERVAL 90 DAYS AS DATE)""",
    "forget_customers": f"""
        SELECT {SALE} FROM sales WHERE customer_id NOT IN (
            SELECT customer_id FROM raw_customers GROUP BY customer_id HAVING COUNT(*) > 1)""",
    "kpi_summary": f"""
        SELECT {REVENUE} AS total_rev, COUNT(DISTINCT transaction_id) AS total_orders,
               ROUND({MEAN_LINE}, 6) AS avg_order_val
        FROM sales WHERE {PERIOD}""",
    "kpi_summary_whole_days": f"""
        SELECT {REVENUE} AS total_rev, COUNT(DISTINCT transaction_id) AS total_orders,
               ROUND({MEAN_LINE}, 6) AS avg_order_val
        FROM sales
        WHERE CAST(transaction_date AS DATE) BETWEEN DATE '{START}' AND DATE '{END}'""",
    "kpi_delta": f"""
        SELECT ROUND((a.r - b.r) / b.r * 100, 6) AS total_rev_pct,
               ROUND((CAST(a.o AS DOUBLE) - b.o) / b.o * 100, 6) AS total_orders_pct,
               ROUND((a.m - b.m) / b.m * 100, 6) AS avg_order_val_pct
        FROM (SELECT {REVENUE} AS r, COUNT(DISTINCT transaction_id) AS o, {MEAN_LINE} AS m FROM sales
              WHERE CAST(transaction_date AS DATE) BETWEEN DATE '{DELTA[0]}' AND DATE '{DELTA[1]}') a,
             (SELECT {REVENUE} AS r, COUNT(DISTINCT transaction_id) AS o, {MEAN_LINE} AS m FROM sales
              WHERE CAST(transaction_date AS DATE) BETWEEN DATE '{DELTA[0]}' - 365 AND DATE '{DELTA[0]}' - 1) b""",
    "kpi_cards": f"""
        SELECT 'Total Revenue' AS label, format('₹{{:,.2f}}', {REVENUE}) AS value FROM sales WHERE {PERIOD}
        UNION ALL SELECT 'Order Volume', format('{{:,}}', COUNT(DISTINCT transaction_id)) FROM sales WHERE {PERIOD}
        UNION ALL SELECT 'Avg. Order Value', format('₹{{:,.2f}}', {MEAN_LINE}) FROM sales WHERE {PERIOD}
        UNION ALL SELECT 'Avg. Delivery Time', format('{{:.1f}} Days', AVG(delivery_time_days)) FROM shipments""",
    "avg_delivery_days": "SELECT ROUND(AVG(delivery_time_days), 6) AS avg_days FROM shipments",
    "daily_revenue": f"""
        SELECT CAST(transaction_date AS DATE) AS sale_date, {REVENUE} AS daily_revenue
        FROM sales WHERE {PERIOD} GROUP BY 1 ORDER BY 1""",
    "monthly_revenue": f"""
        SELECT strftime(transaction_date, '%Y-%m') AS sale_month, {REVENUE} AS monthly_revenue,
               COUNT(DISTINCT transaction_id) AS monthly_orders
        FROM sales WHERE {PERIOD} GROUP BY 1 ORDER BY 1""",
    "seasonal_demand": f"""
        SELECT monthname(transaction_date) AS month, CAST(month(transaction_date) AS INT) AS month_num,
               CAST(SUM(quantity) AS BIGINT) AS units_sold, {REVENUE} AS revenue
        FROM sales WHERE {PERIOD} GROUP BY 1, 2 ORDER BY 2""",
    "city_sales": _city(""),
    "city_sales_current": _city("AND c.is_current"),
    "shopper_type": f"""
        SELECT * FROM (
            WITH visits AS (SELECT DISTINCT customer_id, transaction_id FROM sales WHERE {PERIOD}),
                 once AS (SELECT customer_id FROM visits GROUP BY 1 HAVING COUNT(*) = 1)
            SELECT 'New' AS shopper_type, COUNT(*) AS user_count FROM once HAVING COUNT(*) > 0
            UNION ALL
            SELECT 'Returning', COUNT(DISTINCT customer_id) FROM visits
            WHERE customer_id NOT IN (SELECT customer_id FROM once) HAVING COUNT(*) > 0) kinds""",
    "top_products_revenue": _top("SUM(s.quantity * s.unit_price)", 10),
    "top_products_units": _top("SUM(s.quantity)", 25),
    "top_products_table": f"""
        SELECT substr(product_name, 1, 40) AS "Product", units_sold AS "Units Sold",
               format('₹{{:,.2f}}', revenue) AS "Revenue"
        FROM ({_top("SUM(s.quantity * s.unit_price)", 10)}) t""",
    "customer_clv": f"SELECT name, ROUND(clv_score, 4) AS clv_score FROM ({_clv('')}) t",
    "customer_clv_current": f"""
        SELECT name, ROUND(clv_score, 4) AS clv_score FROM ({_clv('AND c.is_current')}) t""",
    "clv_leaderboard": f"""
        SELECT rank, CASE rank WHEN 1 THEN '🥇' WHEN 2 THEN '🥈' WHEN 3 THEN '🥉'
                     ELSE '#' || CAST(rank AS VARCHAR) END AS medal,
               name, ROUND(clv_score, 4) AS clv_score, format('₹{{:,.0f}}', clv_score) AS expected_value
        FROM (SELECT *, CAST(row_number() OVER (ORDER BY clv_score DESC, name) AS INT) AS rank
              FROM ({_clv('')}) t) r""",
    "analytics_sales_performance": """
        SELECT transaction_id, transaction_date, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
               CAST(quantity * unit_price AS DOUBLE) AS total_revenue,
               (SELECT description FROM products WHERE products.product_id = sales.product_id) AS product_name,
               (SELECT category FROM products WHERE products.product_id = sales.product_id) AS category,
               (SELECT store_name FROM stores WHERE stores.store_id = sales.store_id) AS store_name,
               (SELECT city FROM stores WHERE stores.store_id = sales.store_id) AS store_city
        FROM sales""",
    "analytics_web_engagement": """
        SELECT session_id, customer_id, event_type, event_date, device_type, referrer, promo_code,
               (SELECT category FROM products WHERE products.product_id = web_events.product_id)
                   AS product_category
        FROM web_events""",
    "revenue_validation": f"""
        SELECT COUNT(*) AS total_transactions, {REVENUE} AS total_revenue,
               ROUND({MEAN_LINE}, 6) AS avg_transaction_value,
               MIN(transaction_date) AS earliest_sale, MAX(transaction_date) AS latest_sale
        FROM sales""",
    "inventory_turnover": f"""
        SELECT ROUND(CAST(SUM(quantity) AS DOUBLE)
                     / NULLIF((SELECT AVG(stock_on_hand) FROM inventory), 0), 6) AS turnover_ratio
        FROM sales WHERE {PERIOD}""",
    "category_distribution": """
        SELECT category, COUNT(DISTINCT product_id) AS product_count,
               ROUND(CAST(SUM(base_price) AS DOUBLE) / COUNT(*), 6) AS avg_price
        FROM products GROUP BY category ORDER BY 2 DESC, 1""",
    "inventory_by_store": """
        SELECT store_id, COUNT(DISTINCT product_id) AS products_stocked,
               CAST(SUM(stock_on_hand) AS BIGINT) AS total_inventory,
               ROUND(AVG(stock_on_hand), 6) AS avg_stock_per_product
        FROM inventory GROUP BY store_id""",
    "table_counts": _counts(STAR),
    "profile_sales": "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, COUNT({c}) AS count, COUNT(*) - COUNT({c}) AS null_count,
            ROUND(AVG(CAST({c} AS DOUBLE)), 6) AS mean, ROUND(stddev_samp(CAST({c} AS DOUBLE)), 6) AS stddev,
            CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max FROM raw_sales"""
        for c in ("quantity", "unit_price")
    ),
    "profile_sales_table": "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, COUNT({c}) AS count, COUNT(*) - COUNT({c}) AS null_count,
            {_numbers(c) if number else _NO_NUMBERS},
            {"CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)" if number
             else f"strftime(MIN({c}), '%Y-%m-%d %H:%M:%S') AS first_text, strftime(MAX({c}), '%Y-%m-%d %H:%M:%S') AS last_text"}
            FROM raw_sales"""
        for c, number in (
            ("transaction_date", False), ("transaction_id", True), ("customer_id", True),
            ("product_id", True), ("quantity", True), ("unit_price", True), ("store_id", True),
        )
    ),
    "orphan_report": """
        SELECT 'Orphaned Customers' AS check_type, COUNT(*) AS count
        FROM raw_sales f LEFT JOIN (SELECT customer_id FROM raw_customers GROUP BY 1 HAVING COUNT(*) > 1) d
          ON f.customer_id = d.customer_id WHERE d.customer_id IS NULL
        UNION ALL SELECT 'Orphaned Products', COUNT(*)
        FROM raw_sales f LEFT JOIN products d ON f.product_id = d.product_id WHERE d.product_id IS NULL
        UNION ALL SELECT 'Orphaned Stores', COUNT(*)
        FROM raw_sales f LEFT JOIN stores d ON f.store_id = d.store_id WHERE d.store_id IS NULL""",
    "product_sample": """
        SELECT * REPLACE (CAST(base_price AS DOUBLE) AS base_price) FROM products
        ORDER BY md5(CAST(product_id AS VARCHAR)), product_id LIMIT 100""",
    "product_sample_by_category": """
        SELECT * REPLACE (CAST(base_price AS DOUBLE) AS base_price) FROM products
        QUALIFY row_number() OVER (PARTITION BY category
                                   ORDER BY md5(CAST(product_id AS VARCHAR)), product_id) <= 2""",
    "sales_asof_customer": f"""
        SELECT {SALE.replace("customer_id", "s.customer_id AS customer_id")}, v.name, v.email, v.city,
               v.update_timestamp AS valid_from
        FROM sales s ASOF LEFT JOIN versions_in_order v
          ON s.customer_id = v.customer_id AND s.transaction_date >= v.update_timestamp""",
    "city_sales_asof": f"""
        SELECT v.city, {REVENUE} AS revenue
        FROM sales s ASOF LEFT JOIN versions_in_order v
          ON s.customer_id = v.customer_id AND s.transaction_date >= v.update_timestamp
        WHERE {PERIOD} GROUP BY v.city ORDER BY revenue DESC, v.city NULLS FIRST LIMIT 10""",
    "web_sessions": """
        SELECT * REPLACE (ROUND(revenue, 4) AS revenue),
               CASE WHEN checkout_completed > 0 THEN 'checkout_completed'
                    WHEN checkout_start > 0 THEN 'checkout_start'
                    WHEN add_to_cart > 0 THEN 'add_to_cart'
                    WHEN page_view > 0 THEN 'page_view' END AS furthest
        FROM visits""",
    "session_funnel": """
        SELECT CAST(place AS INT) AS place, step, sessions,
               ROUND(CAST(sessions AS DOUBLE) / first_value(sessions) OVER (ORDER BY place), 9) AS conversion
        FROM (SELECT 1 AS place, 'page_view' AS step, count(*) FILTER (WHERE page_view > 0) AS sessions FROM visits
              UNION ALL SELECT 2, 'add_to_cart', count(*) FILTER (WHERE add_to_cart > 0) FROM visits
              UNION ALL SELECT 3, 'checkout_start', count(*) FILTER (WHERE checkout_start > 0) FROM visits
              UNION ALL SELECT 4, 'checkout_completed', count(*) FILTER (WHERE checkout_completed > 0) FROM visits) x""",
    "store_windows": f"""
        SELECT store_id, window_start, window_start + INTERVAL 7 DAYS AS window_end, COUNT(*) AS lines,
               CAST(SUM(quantity) AS BIGINT) AS units, {REVENUE} AS revenue
        FROM (SELECT *, time_bucket(INTERVAL 7 DAYS, transaction_date, TIMESTAMP '1970-01-01') AS window_start
              FROM sales) x
        GROUP BY store_id, window_start""",
    "store_windows_sliding": f"""
        SELECT store_id, window_start, window_start + INTERVAL 30 DAYS AS window_end, COUNT(*) AS lines,
               CAST(SUM(quantity) AS BIGINT) AS units, {REVENUE} AS revenue
        FROM (SELECT *, time_bucket(INTERVAL 10 DAYS, transaction_date, TIMESTAMP '1970-01-01')
                        - back * INTERVAL 10 DAYS AS window_start
              FROM sales, (SELECT unnest([0, 1, 2]) AS back) b) x
        GROUP BY store_id, window_start""",
    "sales_quality": """
        SELECT COUNT(*) AS total_sales, COUNT(CASE WHEN quantity <= 0 THEN 1 END) AS invalid_qty,
               COUNT(CASE WHEN unit_price <= 0 THEN 1 END) AS invalid_price
        FROM raw_sales""",
    "sales_date_range": """
        SELECT MIN(transaction_date) AS earliest_sale, MAX(transaction_date) AS latest_sale FROM sales""",
    "constraint_report": _constraint_sql(),
    "web_optional_counts": """
        SELECT COUNT(*) AS total_events, COUNT(promo_code) AS events_with_promo,
               COUNT(product_id) AS events_with_product
        FROM web_events""",
    "shipment_status_check": f"""
        SELECT status, COUNT(*) AS shipments FROM shipments
        WHERE status NOT IN ({DOCUMENTED_STATES}) GROUP BY status""",
    "secure_customers": _secure(MASK),
    "secure_customers_strict": _secure(
        f"CASE WHEN {MASK} = email THEN regexp_replace(email, '^[^@]*', '****') ELSE {MASK} END"
    ),
    "secure_customers_extended": rf"""
        SELECT customer_id, regexp_replace(name, '(\w)\w+(\w)', '\1***\2') AS name, city, {MASK} AS email
        FROM customers""",
    "secure_preview": f"""
        SELECT customer_id, name, {MASK} AS email FROM customers
        ORDER BY customer_id, name, email LIMIT 3""",
    "role_views": _counts(GOLD_VIEW_SOURCES, ", 'analyst' AS role")
    + "\nUNION ALL\n"
    + _counts({**RAW_VIEW_SOURCES, **GOLD_VIEW_SOURCES}, ", 'admin' AS role"),
    "live_latest": """
        SELECT *, CAST(row_number() OVER (ORDER BY tick_ts DESC, store_id, sales, inventory) AS INT) AS recency
        FROM live_ticks QUALIFY recency <= 15""",
    "live_panel": """
        SELECT tick_ts, sales, inventory, store_id,
               CASE WHEN r = 1 THEN '₹' || CAST(sales AS VARCHAR) END AS current_sales, r <= 5 AS in_log
        FROM (SELECT *, row_number() OVER (ORDER BY tick_ts DESC, store_id, sales, inventory) AS r
              FROM live_ticks) x
        WHERE r <= 15""",
    "basket_pairs": """
        SELECT s.transaction_id, p.description AS product_name
        FROM sales s JOIN products p ON s.product_id = p.product_id WHERE s.quantity > 0""",
    "baskets": """
        SELECT transaction_id, string_agg(product_name, ', ' ORDER BY product_name) AS items
        FROM (SELECT DISTINCT s.transaction_id, p.description AS product_name
              FROM sales s JOIN products p ON s.product_id = p.product_id WHERE s.quantity > 0) x
        GROUP BY transaction_id""",
    "frequent_itemsets": """
        SELECT array_to_string(items, ', ') AS items, freq, CAST(n AS BIGINT) AS n_baskets,
               ROUND(freq / n, 9) AS support
        FROM sets JOIN total ON true""",
    "association_rules": f"SELECT {RULE_COLUMNS} FROM rules WHERE lifted",
    "association_rules_confidence": f"SELECT {RULE_COLUMNS} FROM rules WHERE confidence >= 0.1",
    "business_rules": f"""
        SELECT {RULE_COLUMNS}, buy_frequency, purchase_likelihood, strength_score FROM business""",
    "rule_insights": f"""
        SELECT CAST(rank AS INT) AS rank, 'Customers who buy: ' || antecedents AS headline,
               'Also tend to buy: ' || consequents AS detail,
               {PERCENT} || ' of customers who bought the first item also bought the second' AS likelihood,
               {STRENGTH} AS strength
        FROM business WHERE rank <= 5""",
    "rule_recommendations": RECOMMENDED,
    "pairing_list": f"""
        SELECT antecedents AS "Customers Buy This", consequents AS "They Also Buy This",
               {PERCENT} AS "Likelihood (%)", {STRENGTH} AS "Strength"
        FROM business""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(query, BASKET | MERGED) for name, query in PLAIN.items()}
