"""Declared schemas of the star schema; nothing is inferred from files."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "MONEY": T.DecimalType(10, 2),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "TEXTS": T.MapType(T.StringType(), T.StringType()),
}


def table(columns: str) -> T.StructType:
    """``"name TYPE, ..."`` → schema; unlike a DDL string it needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Raw files, as they arrive. Keys and timestamps stay text until they are parsed.
RAW_RETAIL = table(
    "InvoiceNo STRING, StockCode STRING, Description STRING, Quantity INT, "
    "InvoiceDate STRING, UnitPrice MONEY, CustomerID STRING, Country STRING"
)
RAW_CUSTOMERS = table(
    "customer_id BIGINT, name STRING, email STRING, city STRING, update_timestamp STRING"
)
RAW_SALES = table(
    "transaction_id STRING, customer_id BIGINT, product_id STRING, quantity INT, "
    "unit_price MONEY, store_id STRING, transaction_date STRING"
)
RAW_INVENTORY = table(
    "store_id STRING, product_id STRING, stock_on_hand INT, last_restock_date STRING"
)
RAW_SHIPMENTS = table(
    "shipment_id STRING, transaction_id STRING, status STRING, delivery_time_days INT, "
    "shipment_date STRING"
)
RAW_TICKS = table("timestamp STRING, sales STRING, inventory STRING, store_id STRING")

# Hub tables, after cleaning.
HUB_TABLES: dict[str, T.StructType] = {
    "dim_customers": table(
        "customer_id BIGINT, name STRING, email STRING, city STRING, "
        "update_timestamp TIMESTAMP, is_current BOOLEAN, valid_from TIMESTAMP"
    ),
    "dim_products": table(
        "product_id STRING, description STRING, base_price MONEY, category STRING, "
        "supplier_id STRING"
    ),
    "dim_stores": table("store_id STRING, store_name STRING, city STRING"),
    "fact_sales": table(
        "transaction_id STRING, customer_id BIGINT, product_id STRING, quantity INT, "
        "unit_price MONEY, store_id STRING, transaction_date TIMESTAMP, "
        "year INT, month INT"
    ),
    "fact_inventory": table(
        "store_id STRING, product_id STRING, stock_on_hand INT, last_restock_date DATE"
    ),
    "fact_shipments": table(
        "shipment_id STRING, transaction_id STRING, status STRING, delivery_time_days INT, "
        "shipment_date DATE"
    ),
    "fact_web_events": table(
        "session_id STRING, customer_id BIGINT, event_type STRING, timestamp TIMESTAMP, "
        "device_type STRING, referrer STRING, product_id STRING, duration_seconds INT, "
        "promo_code STRING, quantity INT, transaction_id STRING, total_value DOUBLE, "
        "extra TEXTS, event_date DATE"
    ),
}

# Web event fields as they stand in a JSON line; other keys are "unexpected" and go to ``extra``.
WEB_EVENT = table(
    "session_id STRING, customer_id BIGINT, event_type STRING, timestamp STRING, "
    "device_type STRING, referrer STRING, product_id STRING, duration_seconds INT, "
    "promo_code STRING, quantity INT, transaction_id STRING, total_value DOUBLE"
)
WEB_EVENT_KNOWN_FIELDS = [field.name for field in WEB_EVENT] + ["event_date"]
WEB_EVENT_KEY = ["session_id", "event_type", "timestamp"]

# Shipment states named by the two conflicting lists of the source material.
SHIPMENT_STATES_GENERATED = ["Processing", "Shipped", "Delivered", "Returned"]
SHIPMENT_STATES_DOCUMENTED = ["Delivered", "In Transit", "Processing", "Delayed"]
