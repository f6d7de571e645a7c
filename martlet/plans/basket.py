"""Market basket: which products are bought together.

Itemsets come from Spark's parallel FP-growth, which never forms the pairs of a basket. Its own
rules have a single item on the right, so rules with every split of an itemset are derived here
by joining the itemsets to themselves on the two sides.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions import join_items, percent
from martlet.session import materialise, scratch

# Bits handled by one explode when an itemset is split; longer sets take two steps.
_MASK_BITS = 14
_BASKETS_PER_GROUP = 100_000


def basket_pairs(sales: DataFrame, products: DataFrame) -> DataFrame:
    """(transaction_id, product_name) for each sold line."""
    s, p = sales.where("quantity > 0").alias("s"), products.alias("p")
    return s.join(p, F.col("s.product_id") == F.col("p.product_id")).select(
        "s.transaction_id", F.col("p.description").alias("product_name")
    )


def _named(pairs: DataFrame) -> DataFrame:
    return pairs.dropna(subset=["transaction_id", "product_name"])


def baskets(pairs: DataFrame) -> DataFrame:
    """One row per transaction with its distinct items, sorted.

    Sets are merged on the map side, so a basket holds at most one entry per product however
    many lines its transaction has.
    """
    return (
        _named(pairs)
        .groupBy("transaction_id")
        .agg(F.array_sort(F.collect_set("product_name")).alias("items"))
    )


def _min_count(n: int, min_support: float) -> int:
    """Smallest count whose share of ``n`` is at least ``min_support``."""
    count = max(0, math.ceil(min_support * n) - 1)
    while n and count / n < min_support:
        count += 1
    return max(count, 1)


def frequent_itemsets(pairs: DataFrame, min_support: float = 0.02) -> DataFrame:
    """Itemsets of any size with at least ``min_support``: items, freq, n_baskets, support.

    Items that are too rare by themselves cannot be in a frequent set; they are removed before
    the baskets are built, which bounds a basket by the number of frequent items. The baskets
    left empty by that still count.
    """
    spark = pairs.sparkSession
    with scratch(spark) as held:
        lines = materialise(_named(pairs).distinct())
        held.append(lines)
        n = lines.select(F.count_distinct("transaction_id")).first()[0]
        if n == 0:
            return spark.createDataFrame(
                [], "items ARRAY<STRING>, freq BIGINT, n_baskets BIGINT, support DOUBLE"
            )
        # The model computes its itemsets anew for every reader; the rules read them three times.
        found = materialise(_mined(lines, n, min_support))
    return found.select(
        "items",
        "freq",
        F.lit(n).cast("bigint").alias("n_baskets"),
        (F.col("freq") / F.lit(float(n))).alias("support"),
    )


def _mined(lines: DataFrame, n: int, min_support: float) -> DataFrame:
    """``items, freq`` of the itemsets in at least ``min_support`` of ``n`` baskets."""
    needed = _min_count(n, min_support)
    frequent = (
        lines.groupBy("product_name")
        .agg(F.count(F.lit(1)).alias("_freq"))
        .where(F.col("_freq") >= needed)
        .select("product_name", F.lit(True).alias("_frequent"))
    )
    item = F.when(F.col("_frequent"), F.col("product_name"))
    small_baskets = (
        lines.join(frequent, "product_name", "left")
        .groupBy("transaction_id")
        .agg(F.collect_list(item).alias("items"))
    )
    # The conditional trees of a group of items live in one task, so groups follow the baskets.
    cores = lines.sparkSession.sparkContext.defaultParallelism
    groups = max(cores, math.ceil(n / _BASKETS_PER_GROUP))
    # Half a basket below the needed count: the model rounds up, so it asks for exactly that.
    model = FPGrowth(
        itemsCol="items", minSupport=(needed - 0.5) / n, numPartitions=groups
    ).fit(small_baskets)
    return model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")


def _splits(itemsets: DataFrame) -> DataFrame:
    """Each itemset with every way to cut it into two non-empty sides.

    A bit mask names a side. Its low and high bits come from two explodes, so no array of all
    2^size masks is ever held.
    """
    size = F.size("items")
    low_bits = F.least(size, F.lit(_MASK_BITS))

    def masks(bits: Column) -> Column:
        return F.pow(F.lit(2), bits).cast("bigint")

    def numbers(bits: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), masks(bits) - 1))

    mask = F.col("_mask")
    masked = (
        itemsets.where(size > 1)
        .withColumn("_high", numbers(size - low_bits))
        .repartition("items", "_high")  # the splits of one large set go to many tasks
        .withColumn("_low", numbers(low_bits))
        .withColumn("_mask", F.shiftleft("_high", _MASK_BITS) + F.col("_low"))
        .where((mask > 0) & (mask < masks(size) - 1))
    )
    left = F.expr("filter(items, (x, i) -> getbit(_mask, i) = 1)")
    right = F.expr("filter(items, (x, i) -> getbit(_mask, i) = 0)")
    return masked.withColumn("antecedents", left).withColumn("consequents", right)


def association_rules(
    itemsets: DataFrame, metric: str = "lift", min_threshold: float = 1.0
) -> DataFrame:
    """Rules from every split of every itemset, with array sides.

    Lift against 1.0 is tested on whole numbers, so a rule whose sides are exactly independent
    is kept whatever the rounding of the quotient.
    """
    sides = itemsets.select(F.col("items").alias("_items"), F.col("freq").alias("_freq"))
    split = _splits(itemsets.select("items", "freq", "n_baskets"))
    rules = (
        split.join(sides.toDF("antecedents", "_left"), "antecedents")
        .join(sides.toDF("consequents", "_right"), "consequents")
        .select(
            "antecedents",
            "consequents",
            (F.col("freq") / F.col("n_baskets")).alias("support"),
            (F.col("freq") / F.col("_left")).alias("confidence"),
            (F.col("freq") / F.col("_left") / (F.col("_right") / F.col("n_baskets"))).alias("lift"),
            *[F.col(c).cast("decimal(19,0)") for c in ("freq", "n_baskets", "_left", "_right")],
        )
    )
    if metric == "lift" and min_threshold == 1.0:
        kept = F.col("freq") * F.col("n_baskets") >= F.col("_left") * F.col("_right")
    elif metric in ("lift", "confidence", "support"):
        kept = F.col(metric) >= min_threshold
    else:
        raise ValueError(f"unknown metric: {metric}")
    return rules.where(kept).select("antecedents", "consequents", "support", "confidence", "lift")


def rules_table(rules: DataFrame) -> DataFrame:
    """Sides as text, strongest first."""
    return rules.select(
        join_items(F.col("antecedents")).alias("antecedents"),
        join_items(F.col("consequents")).alias("consequents"),
        "support",
        "confidence",
        "lift",
    ).orderBy(F.desc("lift"), "antecedents", "consequents")


def market_basket(
    pairs: DataFrame,
    min_support: float = 0.02,
    metric: str = "lift",
    min_threshold: float = 1.0,
) -> DataFrame:
    """Pairs → rules table, in one call."""
    itemsets = frequent_itemsets(pairs, min_support)
    return rules_table(association_rules(itemsets, metric, min_threshold))


def business_rules(table: DataFrame, top: int = 15) -> DataFrame:
    """The strongest rules with rounded business figures (half to even)."""
    return (
        table.orderBy(F.desc("lift"), "antecedents", "consequents")
        .limit(top)
        .withColumn("buy_frequency", F.bround(F.col("support") * 100, 1))
        .withColumn("purchase_likelihood", F.bround(F.col("confidence") * 100, 0))
        .withColumn("strength_score", F.bround("lift", 1))
    )


def _ranked(business: DataFrame, n: int) -> DataFrame:
    """The ``n`` strongest rules, numbered; the limit comes first, so one task sees ``n`` rows."""
    order = [F.desc("lift"), "antecedents", "consequents"]
    strongest = business.orderBy(*order).limit(n)
    return strongest.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def _strength(score: Column) -> Column:
    return F.concat(score.cast("string"), F.lit("x"))


def rule_insights(business: DataFrame, top: int = 5) -> DataFrame:
    """Sentences for the strongest rules."""
    # The wording of the sentences.
    return _ranked(business, top).select(
        "rank",
        F.concat(F.lit("Customers who buy: "), F.col("antecedents")).alias("headline"),
        F.concat(F.lit("Also tend to buy: "), F.col("consequents")).alias("detail"),
        F.concat(
            percent(F.col("purchase_likelihood")),
            F.lit(" of customers who bought the first item also bought the second"),
        ).alias("likelihood"),
        _strength(F.col("strength_score")).alias("strength"),
    )


# Which rule feeds which recommendation, and its wording.
RECOMMENDATIONS = [
    (1, 1, "Store Layout", "Place **%s** near **%s** to increase impulse purchases."),
    (
        2,
        2,
        "Cross-Sell Promotions",
        "Create a bundle offer: Buy **%s**, get a discount on **%s**.",
    ),
    (
        3,
        3,
        "Email Marketing",
        "Send personalized recommendations to customers who bought **%s** suggesting **%s**.",
    ),
    (4, 1, "Inventory Planning", "When stocking **%s**, ensure adequate inventory of **%s**."),
]


def recommendations(business: DataFrame) -> DataFrame:
    """Four recommendations from the three strongest rules, as far as there are rules."""
    texts = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(rank).alias("_rank"),
            F.lit(title).alias("title"),
            F.format_string(template, "antecedents", "consequents").alias("text"),
        )
        for position, rank, title, template in RECOMMENDATIONS
    ]
    return (
        _ranked(business, 3)
        .select("rank", F.inline(F.array(*texts)))
        .where("rank = _rank")
        .select("position", "title", "text")
        .orderBy("position")
    )


def pairing_list(business: DataFrame) -> DataFrame:
    """Display form of the strongest rules."""
    strongest_first = business.orderBy(F.desc("lift"), "antecedents", "consequents")
    return strongest_first.select(
        F.col("antecedents").alias("Customers Buy This"),
        F.col("consequents").alias("They Also Buy This"),
        percent(F.col("purchase_likelihood")).alias("Likelihood (%)"),
        _strength(F.col("strength_score")).alias("Strength"),
    )
