"""The engine's input tables, derived from the given Parquet tables.

Each table is built twice: here with DataFrames, and in ``sql_bindings`` as SQL for the check.
Whole tables are used throughout; the ``%`` terms only plant the data faults that cleaning has
to handle (returns, unpriced parts, missing customers, copies, bad lines).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.operators.customers import scd2_flag
from martlet.operators.sales import clean_sales, floor_inventory
from martlet.operators.web import clean_web_events

# The period of the queries: all sale dates, of which the last day counts at midnight only.
START, END = date(1995, 1, 1), date(2001, 8, 1)

ARRIVAL = ["seq", "event_id"]


class Tables:
    """Input tables of one data folder, built when they are asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._given: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        if name not in self._given:
            self._given[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._given[name]

    def _lines(self, buyers: DataFrame | None = None) -> DataFrame:
        """Order lines with their order and part; prices and dates are made on the small sides.

        So is the join with ``buyers`` by ``c_custkey``, if given: orders are fewer than lines.
        """
        unpriced = F.col("p_partkey") % 50 == 0
        price = F.when(unpriced, F.lit(0.0)).otherwise(F.col("p_retailprice"))
        hour = F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
        parts = self.given("part").select(
            "p_partkey", "p_name", price.cast("decimal(10,2)").alias("unit_price")
        )
        orders = self.given("orders").select(
            "o_orderkey",
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("invoice_date"),
            (F.col("o_orderdate").cast("timestamp_ntz") + hour).alias("transaction_date"),
        )
        if buyers is not None:
            orders = orders.join(buyers, F.col("customer_id") == F.col("c_custkey"))
        returned = F.col("l_returnflag") == "R"
        quantity = F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity"))
        return (
            self.given("lineitem")
            .withColumn("quantity", quantity.cast("int"))
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        )

    @property
    def raw_sales(self) -> DataFrame:
        return self._lines().select(
            F.col("l_orderkey").alias("transaction_id"),
            "customer_id",
            F.col("l_partkey").alias("product_id"),
            "quantity",
            "unit_price",
            F.col("l_suppkey").alias("store_id"),
            "transaction_date",
        )

    @property
    def invoice_texts(self) -> DataFrame:
        """Sales whose ids are texts; some name the same number in two ways, some none."""
        number = F.col("transaction_id")
        plain = number.cast("string")
        other = (
            F.when(F.col("quantity") % 3 == 0, F.concat(F.lit("0"), plain))
            .when(F.col("quantity") % 3 == 1, F.concat(F.lit("C"), plain))
            .otherwise(plain)
        )
        text = F.when(number % 5 == 0, other).otherwise(plain)
        return self.raw_sales.withColumn("transaction_id", text)

    @property
    def sales(self) -> DataFrame:
        return clean_sales(self.raw_sales)

    @property
    def products(self) -> DataFrame:
        return self.given("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("description"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("base_price"),
            F.col("p_type").alias("category"),
            F.concat(F.lit("SUP_"), (100 + F.col("p_partkey") % 900).cast("string")).alias(
                "supplier_id"
            ),
        )

    @property
    def brands(self) -> DataFrame:
        """Products named by their brand: frequent enough for basket rules."""
        return self.given("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("description")
        )

    @property
    def stores(self) -> DataFrame:
        return (
            self.given("supplier")
            .join(self.given("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("store_id"),
                F.col("s_name").alias("store_name"),
                F.col("n_name").alias("city"),
            )
        )

    @staticmethod
    def _email() -> Column:
        usual = F.concat(
            F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")
        )
        return F.when(F.col("c_custkey") % 50 == 0, "ab@x.com").otherwise(usual)

    def _versions(self, rows: DataFrame, city: Column, day: str, spread: int) -> DataFrame:
        updated = F.date_add(F.lit(day).cast("date"), (F.col("c_custkey") % spread).cast("int"))
        return rows.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            self._email().alias("email"),
            city.alias("city"),
            updated.cast("timestamp_ntz").alias("update_timestamp"),
        )

    @property
    def first_customers(self) -> DataFrame:
        located = self.given("customer").join(
            self.given("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        return self._versions(located, F.col("n_name"), "2024-01-01", 150)

    @property
    def moved_customers(self) -> DataFrame:
        moved = self.given("customer").where("c_custkey % 3 = 0")
        city = F.concat(F.lit("NATION_"), ((F.col("c_nationkey") + 7) % 25).cast("string"))
        return self._versions(moved, city, "2024-07-01", 10)

    @property
    def odd_customers(self) -> DataFrame:
        """Versions that tie with the first one, and versions without a time."""
        odd = self.first_customers.where("customer_id % 30 in (4, 5)")
        undated = F.when(F.col("customer_id") % 30 == 4, F.col("update_timestamp"))
        return odd.withColumns({"city": F.lit("ODDTOWN"), "update_timestamp": undated})

    @property
    def raw_customers(self) -> DataFrame:
        return self.first_customers.unionByName(self.moved_customers).unionByName(
            self.odd_customers
        )

    @property
    def customers(self) -> DataFrame:
        return scd2_flag(self.raw_customers)

    @property
    def customer_history(self) -> DataFrame:
        """The versions of the customers, from the time in which they bought."""
        earlier = F.col("update_timestamp") - F.make_ym_interval(F.lit(28))
        return self.raw_customers.withColumn("update_timestamp", earlier)

    @property
    def customer_feed(self) -> DataFrame:
        """Change records: moves, a repeated move, a move back, late ones, and what is known."""

        def at(rows: DataFrame, when: str) -> DataFrame:
            return rows.withColumn("update_timestamp", F.lit(when).cast("timestamp_ntz"))

        first, moved = self.first_customers, self.moved_customers
        return (
            moved.unionByName(at(moved.where("customer_id % 6 = 0"), "2024-08-15"))
            .unionByName(at(first.where("customer_id % 9 = 0"), "2024-09-01"))
            .unionByName(at(first.where("customer_id % 20 = 1"), "2024-08-01"))
            .unionByName(
                at(first.where("customer_id % 20 = 2"), "2023-06-01").withColumn("city", F.lit("LATE"))
            )
            .unionByName(self.odd_customers)
        )

    @property
    def raw_inventory(self) -> DataFrame:
        """Stock of every product a store sells."""
        store, product = F.col("l_suppkey"), F.col("l_partkey")
        restocked = F.date_add(
            F.lit("2024-01-01").cast("date"), ((store + product) % 30).cast("int")
        )
        return self.given("lineitem").select("l_suppkey", "l_partkey").distinct().select(
            store.alias("store_id"),
            product.alias("product_id"),
            ((store * 31 + product * 17) % 551 - 50).cast("int").alias("stock_on_hand"),
            restocked.alias("last_restock_date"),
        )

    @property
    def inventory(self) -> DataFrame:
        return floor_inventory(self.raw_inventory)

    @property
    def shipments(self) -> DataFrame:
        key = F.col("o_orderkey")
        sold = self.given("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
        status = (
            F.when(key % 17 == 0, "Returned")
            .when(F.col("o_orderstatus") == "F", "Delivered")
            .when(F.col("o_orderstatus") == "O", "Shipped")
            .otherwise("Processing")
        )
        return self.given("orders").join(sold, "o_orderkey", "left_semi").select(
            F.concat(F.lit("SHP_"), F.format_string("%07d", key + 1)).alias("shipment_id"),
            key.alias("transaction_id"),
            status.alias("status"),
            (1 + key * 5 % 14).cast("int").alias("delivery_time_days"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("shipment_date"),
        )

    @property
    def raw_web_events(self) -> DataFrame:
        events = self.given("events")
        later = F.make_dt_interval(secs=F.lit(0.25))
        arrived = (
            events.withColumn("seq", F.lit(0))
            .unionByName(events.where("event_id % 60 = 0").withColumn("seq", F.lit(1)))
            .unionByName(
                events.where("event_id % 70 = 5")
                .withColumn("seq", F.lit(3))
                .withColumn("ts", F.col("ts") + later)
            )
        )
        number, kind = F.col("event_id"), F.col("event_type")
        renamed = (
            F.when(kind == "view", "page_view")
            .when(kind == "click", "add_to_cart")
            .when(kind == "purchase", "checkout_completed")
            .when(kind == "signup", "checkout_start")
            .otherwise("search")
        )
        device = F.when(number % 3 == 0, "mobile").when(number % 3 == 1, "desktop")
        promo = (
            F.when(number % 20 == 0, "SAVE10")
            .when(number % 20 == 1, "WELCOME20")
            .when(number % 20 == 2, "FLASH35")
        )
        session = (1000 + F.floor(number / 4)).cast("bigint").cast("string")
        return arrived.select(
            "seq",
            "event_id",
            F.concat(F.lit("sess_"), session).alias("session_id"),
            F.when(number % 83 != 0, F.col("user_id")).alias("customer_id"),
            renamed.alias("event_type"),
            F.col("ts").cast("timestamp_ntz").alias("timestamp"),
            device.otherwise("tablet").alias("device_type"),
            F.when(F.col("seq") == 1, "newsletter").otherwise("direct").alias("referrer"),
            F.when(kind.isin("view", "click", "error"), number * 13 % 2000).alias("product_id"),
            F.when(kind == "view", (10 + number % 291).cast("int")).alias("duration_seconds"),
            promo.alias("promo_code"),
            F.when(kind == "click", (1 + number % 5).cast("int")).alias("quantity"),
            F.when(
                kind == "purchase", F.concat(F.lit("TXN_"), (100000 + number).cast("string"))
            ).alias("transaction_id"),
            F.when(kind == "purchase", F.col("value")).alias("total_value"),
        )

    @property
    def web_events(self) -> DataFrame:
        return clean_web_events(self.raw_web_events, ARRIVAL)

    @property
    def web_lines(self) -> DataFrame:
        """The events as JSON lines with undeclared fields, and the lines that are no events."""
        number = F.col("event_id")
        at = F.replace(F.col("timestamp").cast("string"), F.lit(" "), F.lit("T"))
        at = (
            F.when(number % 97 == 13, "yesterday")
            .when(number % 97 == 14, F.concat(at, F.lit("Z")))
            .when(number % 97 == 15, "2024")
            .when(number % 97 == 16, F.substring(at, 1, 10))
            .otherwise(at)
        )
        # Numbers with a fraction: of zero, which fits, and of a half, which does not.
        customer = F.col("customer_id").cast("decimal(20,1)")
        duration = F.col("duration_seconds") + F.when(number % 41 == 2, 0.5).otherwise(0.0)
        event = F.struct(
            "session_id",
            customer.alias("customer_id"),
            "event_type",
            at.alias("timestamp"),
            "device_type",
            "referrer",
            "product_id",
            duration.cast("decimal(20,1)").alias("duration_seconds"),
            "promo_code",
            "quantity",
            "transaction_id",
            "total_value",
            F.when(number % 40 == 7, "spring").alias("campaign"),
            F.when(number % 90 == 11, "variant_b").alias("ab_test"),
        )
        junk = (
            F.when(number % 100 == 1, "bad{")
            .when(number % 100 == 2, "")
            .when(number % 100 == 3, "{}")
            .when(number % 100 == 4, "5")
            .when(number % 100 == 5, '{"customer_id":1}{"customer_id":2}')
            .when(number % 100 == 6, '{"customer_id":1} junk}')
        )
        lines = self.raw_web_events.select("seq", "event_id", F.to_json(event).alias("value"))
        noise = lines.where("event_id % 100 between 1 and 6 and seq = 0").withColumn("value", junk)
        return lines.unionByName(noise.withColumn("seq", F.lit(2)))

    @property
    def ticks(self) -> DataFrame:
        number = F.col("event_id")
        return self.given("events").select(
            F.col("ts").cast("timestamp_ntz").alias("tick_ts"),
            (100 + number * 37 % 901).cast("int").alias("sales"),
            (10 + number % 41).cast("int").alias("inventory"),
            F.concat(F.lit("ST_"), F.format_string("%03d", 1 + number % 5)).alias("store_id"),
        )

    @property
    def retail(self) -> DataFrame:
        returned = F.col("l_returnflag") == "R"
        buyers = self.given("customer").join(
            self.given("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        located = self._lines(buyers.select("c_custkey", "n_name"))
        shouted = F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))
        return located.select(
            F.concat(
                F.when(returned, "C").otherwise(""), F.col("l_orderkey").cast("string")
            ).alias("invoice_no"),
            F.col("l_partkey").cast("string").alias("stock_code"),
            F.when(F.col("l_partkey") % 40 != 0, shouted).alias("description"),
            "quantity",
            "invoice_date",
            "unit_price",
            F.when(F.col("o_orderkey") % 4 != 0, F.col("customer_id")).alias("customer_id"),
            F.col("n_name").alias("country"),
            F.col("l_linenumber").alias("line_no"),
        )

    @property
    def star(self) -> dict[str, DataFrame]:
        return {
            "dim_customers": self.customers,
            "dim_products": self.products,
            "dim_stores": self.stores,
            "fact_sales": self.sales,
            "fact_inventory": self.inventory,
            "fact_shipments": self.shipments,
            "fact_web_events": self.web_events,
        }
