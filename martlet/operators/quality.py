"""Validation: orphans, declared constraints and the quality report.

Every check is an aggregate. Row rules of a table share one pass; key rules group on the map
side first, so a key with very many rows costs no more than any other.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions import parse_timestamp
from martlet.schemas import WEB_EVENT_KEY


def _as_rows(one_row: DataFrame, fixed: list[str], counts: dict[tuple, str]) -> DataFrame:
    """Turn named counts of a one-row frame into rows: fixed label columns and ``affected``."""
    entries = [
        F.struct(
            *[F.lit(v).alias(label) for v, label in zip(labels, fixed, strict=True)],
            F.coalesce(F.col(column), F.lit(0)).cast("bigint").alias("affected"),
        )
        for labels, column in counts.items()
    ]
    return one_row.select(F.inline(F.array(*entries)))


def _counted(df: DataFrame, fixed: list[str], counts: dict[tuple, Column]) -> DataFrame:
    names = {labels: f"c{i}" for i, labels in enumerate(counts)}
    one_row = df.agg(*[counts[labels].alias(name) for labels, name in names.items()])
    return _as_rows(one_row, fixed, names)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def orphan_count(fact: DataFrame, dim: DataFrame, key: str, allow_null: bool = False) -> DataFrame:
    """Number of fact rows whose key is not in the dimension, as one row."""
    keys = fact.select(key)
    if allow_null:
        keys = keys.where(F.col(key).isNotNull())
    counts = keys.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    lost = counts.join(dim.select(key).distinct(), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("count"))


def _lost_keys(
    fact: DataFrame, checks: dict[str, tuple[str, DataFrame, str]], allow_null: bool
) -> DataFrame:
    """``check, count`` of the fact rows whose key is not in its dimension, in one pass.

    ``checks`` has the fact's column, the dimension and the dimension's column by name. Keys of
    all checks are counted side by side and meet all dimensions in one anti-join.
    """

    def tagged(name: str, key: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), key.cast("string").alias("key"))

    pairs = [tagged(name, F.col(column)) for name, (column, _, _) in checks.items()]
    keys = fact.select(F.explode(F.array(*pairs)).alias("p")).select("p.check", "p.key")
    if allow_null:
        keys = keys.where(F.col("key").isNotNull())
    counts = keys.groupBy("check", "key").agg(F.count(F.lit(1)).alias("_rows"))
    known = _union(
        [
            dim.select(tagged(name, F.col(column)).alias("p")).select("p.check", "p.key")
            for name, (_, dim, column) in checks.items()
        ]
    )
    lost = counts.join(known, ["check", "key"], "left_anti")
    return lost.groupBy("check").agg(F.sum("_rows").alias("count"))


def _with_zeros(counted: DataFrame, names: list[str]) -> DataFrame:
    """The counts as one row with a column for each name, zero where nothing was counted."""
    return counted.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("check") == name, F.col("count"))), F.lit(0)).alias(f"c{i}")
            for i, name in enumerate(names)
        ]
    )


def orphan_report(
    sales: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame
) -> DataFrame:
    """Sales rows without a customer, product or store, a missing key included."""
    checks = {
        "Orphaned Customers": ("customer_id", customers, "customer_id"),
        "Orphaned Products": ("product_id", products, "product_id"),
        "Orphaned Stores": ("store_id", stores, "store_id"),
    }
    names = list(checks)
    one_row = _with_zeros(_lost_keys(sales, checks, allow_null=False), names)
    counts = {(name,): f"c{i}" for i, name in enumerate(names)}
    return _as_rows(one_row, ["check_type"], counts).withColumnRenamed("affected", "count")


@dataclass(frozen=True)
class Rule:
    """One declared constraint. ``kind``: not_null, check, max_length, unique, key, reference."""

    kind: str
    columns: tuple[str, ...]
    detail: str | int | None = None

    @property
    def name(self) -> str:
        shown = f"{self.kind}({', '.join(self.columns)})"
        return shown if self.detail is None else f"{shown} {self.detail}"


# The declared constraints of the star schema.
STAR_RULES: dict[str, list[Rule]] = {
    "dim_customers": [
        Rule("key", ("customer_id",)),
        Rule("not_null", ("name",)),
        Rule("not_null", ("city",)),
        Rule("not_null", ("update_timestamp",)),
        Rule("unique", ("email",)),
        Rule("max_length", ("customer_id",), 10),
        Rule("max_length", ("name",), 100),
        Rule("max_length", ("email",), 150),
        Rule("max_length", ("city",), 100),
    ],
    "dim_products": [
        Rule("key", ("product_id",)),
        Rule("not_null", ("description",)),
        Rule("not_null", ("base_price",)),
        Rule("not_null", ("category",)),
        Rule("not_null", ("supplier_id",)),
        Rule("check", ("base_price",), "> 0"),
        Rule("max_length", ("product_id",), 10),
        Rule("max_length", ("description",), 500),
        Rule("max_length", ("category",), 100),
        Rule("max_length", ("supplier_id",), 10),
    ],
    "dim_stores": [
        Rule("key", ("store_id",)),
        Rule("not_null", ("store_name",)),
        Rule("not_null", ("city",)),
        Rule("max_length", ("store_id",), 10),
        Rule("max_length", ("store_name",), 100),
        Rule("max_length", ("city",), 100),
    ],
    "fact_sales": [
        Rule("key", ("transaction_id",)),
        Rule("not_null", ("customer_id",)),
        Rule("not_null", ("product_id",)),
        Rule("not_null", ("quantity",)),
        Rule("not_null", ("unit_price",)),
        Rule("not_null", ("store_id",)),
        Rule("not_null", ("transaction_date",)),
        Rule("check", ("quantity",), "> 0"),
        Rule("check", ("unit_price",), "> 0"),
        Rule("max_length", ("transaction_id",), 20),
        Rule("max_length", ("customer_id",), 10),
        Rule("max_length", ("product_id",), 10),
        Rule("max_length", ("store_id",), 10),
        Rule("reference", ("customer_id",), "dim_customers"),
        Rule("reference", ("product_id",), "dim_products"),
        Rule("reference", ("store_id",), "dim_stores"),
    ],
    "fact_inventory": [
        Rule("key", ("store_id", "product_id")),
        Rule("not_null", ("stock_on_hand",)),
        Rule("not_null", ("last_restock_date",)),
        Rule("check", ("stock_on_hand",), ">= 0"),
        Rule("reference", ("store_id",), "dim_stores"),
        Rule("reference", ("product_id",), "dim_products"),
    ],
    "fact_shipments": [
        Rule("key", ("shipment_id",)),
        Rule("not_null", ("transaction_id",)),
        Rule("not_null", ("status",)),
        Rule("not_null", ("delivery_time_days",)),
        Rule("not_null", ("shipment_date",)),
        Rule("check", ("delivery_time_days",), ">= 0"),
        Rule("max_length", ("shipment_id",), 20),
        Rule("max_length", ("transaction_id",), 20),
        Rule("max_length", ("status",), 50),
        Rule("reference", ("transaction_id",), "fact_sales"),
    ],
}


def _broken(rule: Rule) -> Column:
    column = F.col(rule.columns[0])
    if rule.kind == "not_null":
        return column.isNull()
    if rule.kind == "max_length":
        return F.length(column.cast("string")) > rule.detail
    if rule.kind == "check":
        # A check holds unless it is false, so an unknown value does not break it.
        return ~F.expr(f"{rule.columns[0]} {rule.detail}")
    raise ValueError(f"not a row rule: {rule.kind}")


def _excess_rows(df: DataFrame, table: str, rules: list[Rule], labels: list[str]) -> DataFrame:
    """Rows beyond the first of each key, for all key rules in one pass; a key must be complete."""
    if len(rules) == 1:
        return _excess_of_one(df, table, rules[0], labels)
    values = [
        F.struct(
            F.lit(i).alias("rule"),
            F.array(*[F.col(c).cast("string") for c in rule.columns]).alias("key"),
        )
        for i, rule in enumerate(rules)
    ]
    keys = df.select(F.explode(F.array(*values)).alias("v")).select("v.rule", "v.key")
    groups = keys.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("_rows"))
    complete = F.forall("key", lambda part: part.isNotNull())
    primary = F.col("rule").isin([i for i, rule in enumerate(rules) if rule.kind == "key"])
    lost = F.when(complete, F.col("_rows") - 1).when(primary, F.col("_rows")).otherwise(0)
    counts = {
        (table, rule.name): F.sum(F.when(F.col("rule") == i, lost)) for i, rule in enumerate(rules)
    }
    return _counted(groups, labels, counts)


def _excess_of_one(df: DataFrame, table: str, rule: Rule, labels: list[str]) -> DataFrame:
    """The same for a single rule, whose columns are grouped as they are."""
    groups = df.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("_rows"))
    complete = F.lit(True)
    for column in rule.columns:
        complete = complete & F.col(column).isNotNull()
    lost = F.when(complete, F.col("_rows") - 1).otherwise(F.col("_rows") if rule.kind == "key" else 0)
    return _counted(groups, labels, {(table, rule.name): F.sum(lost)})


def constraint_report(
    table: str, df: DataFrame, rules: list[Rule], tables: dict[str, DataFrame]
) -> DataFrame:
    """Violations per rule: rows that break it; for keys, rows beyond the first and null keys."""
    labels = ["table_name", "rule"]
    row_rules = [r for r in rules if r.kind in ("not_null", "check", "max_length")]
    parts = []
    if row_rules:
        counts = {(table, r.name): F.count_if(_broken(r)) for r in row_rules}
        parts.append(_counted(df, labels, counts))
    keyed = [r for r in rules if r.kind in ("key", "unique")]
    if keyed:
        parts.append(_excess_rows(df, table, keyed, labels))
    references = {r.name: (r.columns[0], tables[r.detail], r.columns[0]) for r in rules if r.kind == "reference"}
    if references:
        names = list(references)
        one_row = _with_zeros(_lost_keys(df, references, allow_null=True), names)
        parts.append(_as_rows(one_row, labels, {(table, n): f"c{i}" for i, n in enumerate(names)}))
    return _union(parts).withColumnRenamed("affected", "violations")


def star_constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [
            constraint_report(name, tables[name], rules, tables)
            for name, rules in STAR_RULES.items()
            if name in tables
        ]
    )


def sales_quality(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.count(F.lit(1)).alias("total_sales"),
        F.count_if(F.col("quantity") <= 0).alias("invalid_qty"),
        F.count_if(F.col("unit_price") <= 0).alias("invalid_price"),
    )


def sales_date_range(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.min("transaction_date").alias("earliest_sale"),
        F.max("transaction_date").alias("latest_sale"),
    )


def web_optional_counts(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count("promo_code").alias("events_with_promo"),
        F.count("product_id").alias("events_with_product"),
    )


def shipment_status_check(shipments: DataFrame, allowed: list[str]) -> DataFrame:
    """Rows per status that is not allowed; a missing status is not allowed either."""
    known = F.coalesce(F.col("status").isin(allowed), F.lit(False))
    return shipments.where(~known).groupBy("status").agg(F.count(F.lit(1)).alias("shipments"))


def quality_report(
    customers: DataFrame | None = None,
    sales: DataFrame | None = None,
    inventory: DataFrame | None = None,
    events: DataFrame | None = None,
    bad_lines: DataFrame | None = None,
    unfit: DataFrame | None = None,
    unreadable_files: int | None = None,
) -> DataFrame:
    """What each cleaning rule does to the raw tables: source, check, action, affected rows.

    ``customers`` carries is_current; the others are raw. The counts are aggregates of the
    tables themselves, so a task that runs twice does not change them.
    """
    labels = ["source", "check", "action"]
    parts = []
    if customers is not None:
        parts.append(
            _counted(
                customers,
                labels,
                {
                    ("dim_customers", "duplicate customer_id", "flag history"): F.count_if(
                        ~F.col("is_current")
                    )
                },
            )
        )
    if sales is not None:
        quantity, price = F.col("quantity"), F.col("unit_price")
        kept = F.coalesce((quantity > 0) & (price > 0), F.lit(False))
        parts.append(
            _counted(
                sales,
                labels,
                {
                    ("fact_sales", "quantity <= 0", "drop row"): F.count_if(quantity <= 0),
                    ("fact_sales", "unit_price <= 0", "drop row"): F.count_if(price <= 0),
                    ("fact_sales", "all rules", "drop row"): F.count_if(~kept),
                },
            )
        )
    if inventory is not None:
        parts.append(
            _counted(
                inventory,
                labels,
                {
                    ("fact_inventory", "stock_on_hand < 0", "floor to 0"): F.count_if(
                        F.col("stock_on_hand") < 0
                    )
                },
            )
        )
    if events is not None:
        parts.append(_event_counts(events, labels))
    if bad_lines is not None:
        parts.append(
            _counted(
                bad_lines,
                labels,
                {("fact_web_events", "JSON parse error", "skip line"): F.count(F.lit(1))},
            )
        )
    if unfit is not None:
        check = ("fact_web_events", "value does not fit", "set to null")
        parts.append(_counted(unfit, labels, {check: F.sum("affected")}))
    if unreadable_files is not None:
        check = ("fact_web_events", "unreadable file", "skip file")
        counted = parts[0].sparkSession.range(1)
        parts.append(_counted(counted, labels, {check: F.lit(unreadable_files)}))
    return _union(parts)


def _event_counts(events: DataFrame, labels: list[str]) -> DataFrame:
    with_customer = F.col("customer_id").isNotNull()
    text = dict(events.dtypes)["timestamp"] == "string"
    when = parse_timestamp(F.col("timestamp")) if text else F.col("timestamp")
    optional = ["product_id", "duration_seconds", "promo_code", "quantity", "transaction_id"]
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in optional])
    # Grouping by the event key first keeps one row per key and task, copies included.
    keyed = (
        events.withColumn("_undated", when.isNull())
        .withColumn("_missing", missing)
        .groupBy(*WEB_EVENT_KEY, with_customer.alias("_kept"), "_undated")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.count_if("_missing").alias("_with_missing"),
        )
    )
    rows = F.col("_rows")
    return _counted(
        keyed,
        labels,
        {
            ("fact_web_events", "customer_id is null", "drop row"): F.sum(
                F.when(~F.col("_kept"), rows)
            ),
            ("fact_web_events", "duplicate event", "keep first"): F.sum(
                F.when(F.col("_kept"), rows - 1)
            ),
            ("fact_web_events", "invalid timestamp", "quarantine"): F.count_if(
                F.col("_kept") & F.col("_undated")
            ),
            ("fact_web_events", "missing optional field", "set to null"): F.sum(
                F.when(F.col("_kept"), F.col("_with_missing"))
            ),
        },
    )
