"""From raw invoice lines to the star schema.

Input columns: invoice_no, stock_code, description, quantity, invoice_date, unit_price,
customer_id, country and an arrival order (``line_no`` unless told otherwise).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions import padded_id, title_text
from martlet.operators.skew import first_per_key, with_row_number


def drop_null_customers(retail: DataFrame) -> DataFrame:
    """Keep lines with a customer; the id becomes BIGINT (``17850.0`` is read as 17850)."""
    number = F.col("customer_id")
    if dict(retail.dtypes)["customer_id"] == "string":
        number = number.try_cast("decimal(20,2)")
    return retail.withColumn("customer_id", number.try_cast("bigint")).dropna(subset=["customer_id"])


def derive_products(retail: DataFrame, order: list[str]) -> DataFrame:
    """One row per stock code: the first line by ``order`` gives description and price."""
    lines = retail.select(
        F.col("stock_code").alias("product_id"),
        "description",
        F.col("unit_price").alias("base_price"),
        *[c for c in order if c not in ("stock_code", "description", "unit_price")],
    )
    renamed = {"stock_code": "product_id", "unit_price": "base_price"}
    first = first_per_key(lines, ["product_id"], [renamed.get(c, c) for c in order])
    return first.select("product_id", "description", "base_price")


def derive_customers(retail: DataFrame) -> DataFrame:
    return retail.select("customer_id").distinct()


def map_sales(retail: DataFrame) -> DataFrame:
    """Rename the five sales columns; returns are kept here and dropped by ``clean_sales``."""
    return retail.select(
        F.col("invoice_no").alias("transaction_id"),
        "customer_id",
        F.col("stock_code").alias("product_id"),
        "quantity",
        "unit_price",
    )


def derive_shipments(sales: DataFrame) -> DataFrame:
    """One shipment per distinct transaction.

    The id comes from the transaction's own number, so no global numbering is needed. Only a
    transaction id that is its number's plain text is padded. Other texts are kept whole, and
    those that read as a number (``0123``) get a mark, so no two share a shipment id.
    """
    text = F.col("transaction_id").cast("string")
    number = text.try_cast("bigint")
    plain = (number.cast("string") == text) & (number >= 0)
    marked = number.isNotNull() | text.startswith("#")
    return sales.select("transaction_id").distinct().select(
        F.when(plain, padded_id("SHP_", number, 7))
        .otherwise(F.concat(F.lit("SHP_"), F.when(marked, "#").otherwise(""), text))
        .alias("shipment_id"),
        "transaction_id",
    )


def retail_clean(retail: DataFrame) -> DataFrame:
    """Drop cancellations (``C…``), returns, lines without a customer and unpriced lines."""
    return retail.where(
        ~F.col("invoice_no").startswith("C")
        & (F.col("quantity") > 0)
        & F.col("customer_id").isNotNull()
        & (F.col("unit_price") > 0)
    )


def line_transaction_ids(retail: DataFrame, order: list[str]) -> DataFrame:
    """Ids of single lines: ``TXN{invoice}-{n}``, ``CUST{customer}``, ``PROD{stock code}``."""
    numbered = with_row_number(retail, "invoice_no", order, "line_in_invoice")

    def prefixed(prefix: str, column: str) -> Column:
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    return numbered.select(
        F.concat(prefixed("TXN", "invoice_no"), F.lit("-"), F.col("line_in_invoice")).alias(
            "transaction_id"
        ),
        prefixed("CUST", "customer_id").alias("customer_id"),
        prefixed("PROD", "stock_code").alias("product_id"),
        "quantity",
        "unit_price",
        "invoice_no",
        "line_in_invoice",
    )


def standardize_description(products: DataFrame) -> DataFrame:
    """Drop products without a description; trim and title-case the rest."""
    text = F.trim("description")
    return products.where(text.isNotNull() & (text != "")).withColumn(
        "description", title_text(F.col("description"))
    )


def categorize(
    products: DataFrame,
    rules: list[tuple[str, str]],
    suppliers: dict[str, str],
    default: str = "Other",
) -> DataFrame:
    """Category of the first rule whose keyword occurs in the description; supplier by category.

    The rules are configuration, so they become one expression and no join is needed.
    """
    text = F.lower("description")
    hits = [F.when(text.contains(word.lower()), F.lit(category)) for word, category in rules]
    by_category = F.create_map(*[F.lit(v) for pair in suppliers.items() for v in pair])
    return products.withColumn("category", F.coalesce(*hits, F.lit(default))).withColumn(
        "supplier_id", F.try_element_at(by_category, F.col("category"))
    )


def enrich_customers(
    customers: DataFrame, city_map: dict[str, str], as_of: str, domain: str = "email.com"
) -> DataFrame:
    """City from country, email from the name pattern, and the time of the run."""
    cities = F.create_map(*[F.lit(v) for pair in city_map.items() for v in pair])
    local_part = F.lower(F.replace(F.trim("name"), F.lit(" "), F.lit(".")))
    return customers.select(
        "customer_id",
        "name",
        F.concat(local_part, F.lit(f"@{domain}")).alias("email"),
        F.coalesce(F.try_element_at(cities, F.col("country")), F.col("country")).alias("city"),
        F.lit(as_of).cast("timestamp_ntz").alias("update_timestamp"),
    )


def dedup_pk(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per primary key: the first by the declared order."""
    return first_per_key(df, key, order)


def sample_rows(df: DataFrame, fraction: float, key: str | None = None, seed: int = 0) -> DataFrame:
    """A random share of the rows; with ``key``, a share of the keys that is the same each run."""
    if key is None:
        return df.sample(fraction, seed=seed)
    limit = f"{int(fraction * 0x100000000):08x}" if fraction < 1.0 else "g"
    digest = F.md5(F.col(key).cast("string").cast("binary"))
    return df.where(F.substring(digest, 1, 8) < F.lit(limit))


def sample_n(df: DataFrame, n: int, key: list[str], by: str | None = None) -> DataFrame:
    """Exactly ``n`` rows, or all if there are fewer; with ``by``, so many of each of its values.

    The rows with the smallest hashes of ``key``, ties by the key and then the other columns, so
    each run gives the same. Tasks keep their own ``n`` smallest before anything is shuffled.
    """
    text = F.concat_ws("\x1f", *[F.col(k).cast("string") for k in key])
    rest = [c for c in df.columns if c not in key]
    order = [F.md5(text.cast("binary")), *key, *rest]
    if by is None:
        return df.orderBy(*order).limit(n)
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")
