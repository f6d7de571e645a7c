"""The named business queries.

Sums per key are taken before a dimension is joined, on both sides: the join then sees one row
per key, whatever number of sales or versions the key has. Results equal the row-level join.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.functions import count_text, money, month_label, month_name
from martlet.operators.customers import customer_at_sale
from martlet.operators.sales import in_period, revenue


def _rows() -> Column:
    return F.count(F.lit(1))


def kpi_summary(sales: DataFrame, start: date, end: date, **period) -> DataFrame:
    """Revenue, distinct orders and the mean value of a line; nulls for an empty period."""
    return in_period(sales, start, end, **period).agg(
        F.sum(revenue()).alias("total_rev"),
        F.count_distinct("transaction_id").alias("total_orders"),
        _mean(revenue()).alias("avg_order_val"),
    )


def _mean(amount: Column) -> Column:
    """Mean from the exact decimal sum."""
    return F.try_divide(F.sum(amount).cast("double"), F.count(amount).cast("double"))


def kpi_delta(sales: DataFrame, start: date, end: date) -> DataFrame:
    """KPIs of the period against the period of the same length before it, in percent."""
    days = (end - start).days + 1
    before = start - timedelta(days=days)
    both = in_period(sales, before, end, end_inclusive_day=True)
    now = F.col("transaction_date") >= F.lit(start).cast("timestamp_ntz")
    # Orders are counted per half, so one pass serves both periods.
    halves = both.groupBy(now.alias("_now")).agg(
        F.sum(revenue()).alias("_rev"),
        F.count_distinct("transaction_id").alias("_orders"),
        _mean(revenue()).alias("_mean"),
    )

    def change(column: str) -> Column:
        this = F.max(F.when(F.col("_now"), F.col(column))).cast("double")
        last = F.max(F.when(~F.col("_now"), F.col(column))).cast("double")
        return F.round(F.try_divide(this - last, last) * 100, 6)

    return halves.agg(
        change("_rev").alias("total_rev_pct"),
        change("_orders").alias("total_orders_pct"),
        change("_mean").alias("avg_order_val_pct"),
    )


def avg_delivery_days(shipments: DataFrame) -> DataFrame:
    return shipments.agg(F.avg("delivery_time_days").alias("avg_days"))


def kpi_cards(kpis: DataFrame, delivery: DataFrame) -> DataFrame:
    """The four headline figures as text."""
    shown = {
        "Total Revenue": money(F.col("total_rev")),
        "Order Volume": count_text(F.col("total_orders")),
        "Avg. Order Value": money(F.col("avg_order_val")),
    }
    entries = [
        F.struct(F.lit(label).alias("label"), value.alias("value"))
        for label, value in shown.items()
    ]
    cards = kpis.select(F.inline(F.array(*entries)))
    days = F.format_string("%.1f Days", F.bround("avg_days", 1))
    return cards.unionByName(
        delivery.select(
            F.lit("Avg. Delivery Time").alias("label"),
            F.when(F.col("avg_days").isNotNull(), days).otherwise("N/A").alias("value"),
        )
    )


def daily_revenue(sales: DataFrame, start: date, end: date, **period) -> DataFrame:
    return (
        in_period(sales, start, end, **period)
        .groupBy(F.to_date("transaction_date").alias("sale_date"))
        .agg(F.sum(revenue()).alias("daily_revenue"))
        .orderBy("sale_date")
    )


def monthly_revenue(sales: DataFrame, start: date, end: date, **period) -> DataFrame:
    return (
        in_period(sales, start, end, **period)
        .groupBy(month_label(F.col("transaction_date")).alias("sale_month"))
        .agg(
            F.sum(revenue()).alias("monthly_revenue"),
            F.count_distinct("transaction_id").alias("monthly_orders"),
        )
        .orderBy("sale_month")
    )


def seasonal_demand(sales: DataFrame, start: date, end: date, **period) -> DataFrame:
    """Units and revenue per calendar month, all years together."""
    ts = F.col("transaction_date")
    by_month = (
        in_period(sales, start, end, **period)
        .groupBy(month_name(ts).alias("month"), F.month(ts).alias("month_num"))
        .agg(F.sum("quantity").alias("units_sold"), F.sum(revenue()).alias("revenue"))
    )
    return by_month.orderBy("month_num")


def city_sales(
    sales: DataFrame,
    customers: DataFrame,
    start: date,
    end: date,
    n: int = 10,
    current_only: bool = False,
    **period,
) -> DataFrame:
    """Revenue of the top cities.

    By default every version of a customer counts, so the sales of a customer who moved are
    counted for each version; ``current_only`` counts the current version.
    """
    versions = customers.where("is_current") if current_only else customers
    by_customer = (
        in_period(sales, start, end, **period)
        .groupBy("customer_id")
        .agg(F.sum(revenue()).alias("_revenue"))
    )
    per_city = versions.groupBy("customer_id", "city").agg(_rows().alias("_versions"))
    return (
        by_customer.join(per_city, "customer_id")
        .groupBy("city")
        .agg(F.sum(F.col("_revenue") * F.col("_versions")).alias("revenue"))
        .orderBy(F.desc("revenue"), "city")
        .limit(n)
    )


def city_sales_asof(
    sales: DataFrame, versions: DataFrame, start: date, end: date, n: int = 10, **period
) -> DataFrame:
    """Revenue of the top cities, each sale counted for the city its customer lived in then.

    Sales are added up per customer and instant first. Sales before the customer's first version
    have no city and are one entry, with a null.
    """
    instants = (
        in_period(sales, start, end, **period)
        .groupBy("customer_id", "transaction_date")
        .agg(F.sum(revenue()).alias("_revenue"))
    )
    return (
        customer_at_sale(instants, versions)
        .groupBy("city")
        .agg(F.sum("_revenue").alias("revenue"))
        .orderBy(F.desc("revenue"), "city")
        .limit(n)
    )


def shopper_type(sales: DataFrame, start: date, end: date, **period) -> DataFrame:
    """Customers with exactly one transaction are new, all others returning.

    One transaction means that the smallest and the largest id agree, which needs no set of
    ids. Sales without a customer form one group.
    """
    by_customer = (
        in_period(sales, start, end, **period)
        .groupBy("customer_id")
        .agg(F.min("transaction_id").alias("_first"), F.max("transaction_id").alias("_last"))
    )
    kind = F.when(F.col("_first") == F.col("_last"), "New").otherwise("Returning")
    return by_customer.groupBy(kind.alias("shopper_type")).agg(_rows().alias("user_count"))


# Sort columns a caller may name.
RANKINGS = {"revenue": "revenue", "units": "units_sold"}


def top_products(
    sales: DataFrame,
    products: DataFrame,
    start: date,
    end: date,
    n: int = 10,
    by: str = "revenue",
    **period,
) -> DataFrame:
    """Best-selling descriptions; products that share a description are one entry."""
    rank = RANKINGS[by]
    by_product = (
        in_period(sales, start, end, **period)
        .where("quantity > 0")
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("_units"), F.sum(revenue()).alias("_revenue"))
    )
    names = products.groupBy("product_id", "description").agg(_rows().alias("_entries"))
    return (
        by_product.join(names, "product_id")
        .groupBy(F.col("description").alias("product_name"))
        .agg(
            F.sum(F.col("_units") * F.col("_entries")).alias("units_sold"),
            F.sum(F.col("_revenue") * F.col("_entries")).alias("revenue"),
        )
        .orderBy(F.desc(rank), "product_name")
        .limit(n)
    )


def top_products_table(top: DataFrame) -> DataFrame:
    """Display form: names cut to 40 characters, revenue as text."""
    return top.select(
        F.substring("product_name", 1, 40).alias("Product"),
        F.col("units_sold").alias("Units Sold"),
        money(F.col("revenue")).alias("Revenue"),
    )


def customer_clv(
    sales: DataFrame,
    customers: DataFrame,
    start: date,
    end: date,
    n: int = 8,
    multiplier: float = 1.5,
    current_only: bool = False,
    **period,
) -> DataFrame:
    """Mean line value x distinct orders x multiplier, top ``n``.

    By default each version of a customer is an entry of its own; ``current_only`` keeps one.
    """
    versions = customers.where("is_current") if current_only else customers
    metrics = (
        in_period(sales, start, end, **period)
        .groupBy("customer_id")
        .agg(
            _mean(revenue()).alias("_aov"),
            F.count_distinct("transaction_id").alias("_frequency"),
        )
    )
    names = versions.groupBy("customer_id", "name").agg(_rows().alias("_entries"))
    scored = metrics.join(names, "customer_id").select(
        "name",
        (F.col("_aov") * F.col("_frequency") * F.lit(multiplier)).alias("clv_score"),
        # No more than n copies of one entry can be in the result.
        F.explode(F.sequence(F.lit(1), F.least(F.col("_entries"), F.lit(n)).cast("int"))),
    )
    return (
        scored.orderBy(F.col("clv_score").desc_nulls_last(), "name")
        .limit(n)
        .select("name", "clv_score")
    )


def clv_leaderboard(clv: DataFrame, n: int = 8) -> DataFrame:
    """Rank, medal and display text of the top ``n``; the limit comes before the numbering."""
    order = [F.col("clv_score").desc_nulls_last(), "name"]
    place = F.col("rank")
    medal = (
        F.when(place == 1, "🥇")
        .when(place == 2, "🥈")
        .when(place == 3, "🥉")
        .otherwise(F.concat(F.lit("#"), place.cast("string")))
    )
    top = clv.orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order))).select(
        "rank",
        medal.alias("medal"),
        "name",
        "clv_score",
        money(F.bround("clv_score", 0), 0).alias("expected_value"),
    )


def sales_performance(sales: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Every sale with its product and store, missing ones included."""
    s, p, st = sales.alias("s"), products.alias("p"), stores.alias("st")
    return (
        s.join(p, F.col("s.product_id") == F.col("p.product_id"), "left")
        .join(st, F.col("s.store_id") == F.col("st.store_id"), "left")
        .select(
            "s.transaction_id",
            "s.transaction_date",
            F.col("p.description").alias("product_name"),
            "p.category",
            "st.store_name",
            F.col("st.city").alias("store_city"),
            "s.quantity",
            "s.unit_price",
            (F.col("s.quantity") * F.col("s.unit_price")).alias("total_revenue"),
        )
    )


def web_engagement(events: DataFrame, products: DataFrame) -> DataFrame:
    """Every event with the category of its product, if it has one."""
    we, p = events.alias("we"), products.alias("p")
    return we.join(p, F.col("we.product_id") == F.col("p.product_id"), "left").select(
        "we.session_id",
        "we.customer_id",
        "we.event_type",
        "we.event_date",
        "we.device_type",
        "we.referrer",
        F.col("p.category").alias("product_category"),
        "we.promo_code",
    )


def revenue_validation(sales: DataFrame) -> DataFrame:
    return sales.agg(
        _rows().alias("total_transactions"),
        F.sum(revenue()).alias("total_revenue"),
        _mean(revenue()).alias("avg_transaction_value"),
        F.min("transaction_date").alias("earliest_sale"),
        F.max("transaction_date").alias("latest_sale"),
    )


def inventory_turnover(
    sales: DataFrame, inventory: DataFrame, start: date, end: date, **period
) -> DataFrame:
    """Units sold over mean stock; null when there is no stock."""
    sold = in_period(sales, start, end, **period).agg(F.sum("quantity").alias("_units"))
    stock = inventory.agg(F.avg("stock_on_hand").alias("_stock"))
    both = sold.unionByName(stock, allowMissingColumns=True)
    return both.agg(
        F.try_divide(F.max("_units").cast("double"), F.max("_stock")).alias("turnover_ratio")
    )


def category_distribution(products: DataFrame) -> DataFrame:
    return (
        products.groupBy("category")
        .agg(
            F.count_distinct("product_id").alias("product_count"),
            _mean(F.col("base_price")).alias("avg_price"),
        )
        .orderBy(F.desc("product_count"), "category")
    )


def inventory_by_store(inventory: DataFrame) -> DataFrame:
    """Products and stock of each store.

    Distinct products take a hash table of all rows of a task. So the rows are dealt to all
    partitions of the session first: adaptive execution would leave as many as there are cores.
    The product goes first, else Spark skips the step where rows lie by (store, product) already.
    """
    parts = int(inventory.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return inventory.repartition(parts, "product_id", "store_id").groupBy("store_id").agg(
        F.count_distinct("product_id").alias("products_stocked"),
        F.sum("stock_on_hand").alias("total_inventory"),
        F.avg("stock_on_hand").alias("avg_stock_per_product"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(_rows().alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, nulls, mean, deviation, minimum and maximum of numeric columns, in one pass."""
    stats = {
        "count": F.count,
        "null_count": lambda c: F.count_if(c.isNull()),
        "mean": lambda c: F.avg(c.cast("double")),
        "stddev": lambda c: F.stddev_samp(c.cast("double")),
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }

    def entry(column: str) -> Column:
        values = [f(F.col(column)).alias(name) for name, f in stats.items()]
        return F.struct(F.lit(column).alias("column_name"), *values).alias(column)

    one_row = df.agg(*[entry(c) for c in columns])
    return one_row.select(F.inline(F.array(*[F.col(c) for c in columns])))


def profile_table(df: DataFrame) -> DataFrame:
    """The profile of every column, in one pass: numbers as in ``profile``, others by their text.

    Columns without an order as text (maps, arrays) have only their counts.
    """
    numeric = (T.NumericType,)

    def entry(field: T.StructField) -> Column:
        value, none = F.col(f"`{field.name}`"), F.lit(None)
        number = value.cast("double") if isinstance(field.dataType, numeric) else None
        shown = isinstance(field.dataType, T.AtomicType) and number is None
        text = value.cast("string") if shown else none.cast("string")
        return F.struct(
            F.lit(field.name).alias("column_name"),
            F.count(value).alias("count"),
            F.count_if(value.isNull()).alias("null_count"),
            (F.avg(number) if number is not None else none.cast("double")).alias("mean"),
            (F.stddev_samp(number) if number is not None else none.cast("double")).alias("stddev"),
            (F.min(number) if number is not None else none.cast("double")).alias("min"),
            (F.max(number) if number is not None else none.cast("double")).alias("max"),
            (F.min(text) if shown else text).alias("first_text"),
            (F.max(text) if shown else text).alias("last_text"),
        )

    entries = [entry(field).alias(f"c{i}") for i, field in enumerate(df.schema)]
    one_row = df.agg(*entries)
    return one_row.select(F.inline(F.array(*[F.col(f"c{i}") for i in range(len(entries))])))
