from __future__ import annotations

from itertools import combinations

import pytest

from martlet.plans import basket

PAIRS = "transaction_id INT, product_name STRING"


def brute_force(baskets: dict[int, set], min_support: float):
    """Itemsets and rules by counting, for small baskets."""
    n = len(baskets)
    items = sorted(set().union(*baskets.values()))
    counts = {}
    for size in range(1, len(items) + 1):
        for subset in combinations(items, size):
            freq = sum(set(subset) <= b for b in baskets.values())
            if freq and freq / n >= min_support:
                counts[subset] = freq
    rules = {}
    for whole, freq in counts.items():
        for size in range(1, len(whole)):
            for left in combinations(whole, size):
                right = tuple(i for i in whole if i not in left)
                if freq * n >= counts[left] * counts[right]:
                    rules[left, right] = (freq / n, freq / counts[left])
    return counts, rules


def pairs_of(baskets):
    return [(t, i) for t, items in baskets.items() for i in items]


def test_small_sample(frame, rows):
    pairs = frame(PAIRS, (1, "Milk"), (1, "Bread"), (2, "Milk"), (2, "Diapers"), (3, "Milk"), (3, "Milk"), (4, None))
    assert rows(basket.baskets(pairs)) == [(1, ["Bread", "Milk"]), (2, ["Diapers", "Milk"]), (3, ["Milk"])]
    found = {tuple(r["items"]): r["freq"] for r in basket.frequent_itemsets(pairs, 0.3).collect()}
    assert found == {("Milk",): 3, ("Bread",): 1, ("Diapers",): 1, ("Bread", "Milk"): 1, ("Diapers", "Milk"): 1}
    table = basket.market_basket(pairs, 0.3).collect()
    # Milk is in every basket, so each rule is exactly independent: lift 1.0 is kept.
    assert [(r.antecedents, r.consequents, r.lift) for r in table] == [
        ("Bread", "Milk", 1.0),
        ("Diapers", "Milk", 1.0),
        ("Milk", "Bread", pytest.approx(1.0)),
        ("Milk", "Diapers", pytest.approx(1.0)),
    ]


@pytest.mark.parametrize("min_support", [0.1, 0.15])
def test_rules_equal_brute_force(frame, min_support):
    baskets = {t: {f"i{k}" for k in range(7) if (t * 7 + k * k) % (k + 2) < 2} for t in range(40)}
    baskets = {t: b for t, b in baskets.items() if b}
    counts, rules = brute_force(baskets, min_support)
    assert max(len(s) for s in counts) >= 4
    itemsets = basket.frequent_itemsets(frame(PAIRS, *pairs_of(baskets)), min_support)
    assert {tuple(r["items"]): r.freq for r in itemsets.collect()} == counts
    got = basket.association_rules(itemsets).collect()
    assert len(got) == len(rules)
    for r in got:
        support, confidence = rules[tuple(r.antecedents), tuple(r.consequents)]
        assert (r.support, r.confidence) == (pytest.approx(support), pytest.approx(confidence))
        assert r.support >= min_support and r.lift >= 1 - 1e-12


def test_long_itemsets_split_in_two_steps(frame, monkeypatch):
    baskets = {t: {f"i{k}" for k in range(6)} for t in range(3)}
    itemsets = basket.frequent_itemsets(frame(PAIRS, *pairs_of(baskets)), 0.5)
    whole = {(tuple(r.antecedents), tuple(r.consequents)) for r in basket.association_rules(itemsets).collect()}
    monkeypatch.setattr(basket, "_MASK_BITS", 2)
    cut = {(tuple(r.antecedents), tuple(r.consequents)) for r in basket.association_rules(itemsets).collect()}
    assert whole == cut and len(whole) == 3**6 - 2 * 2**6 + 1


def test_min_count_is_exact():
    assert basket._min_count(30, 0.1) == 3
    assert basket._min_count(50, 0.02) == 1
    assert basket._min_count(51, 0.02) == 2
    for n in range(1, 300):
        for support in (0.01, 0.07, 0.1, 0.3, 0.7):
            needed = basket._min_count(n, support)
            assert needed / n >= support and (needed == 1 or (needed - 1) / n < support)


def test_confidence_metric_and_bad_metric(frame):
    itemsets = basket.frequent_itemsets(frame(PAIRS, (1, "a"), (1, "b"), (2, "a"), (3, "a")), 0.3)
    strong = basket.association_rules(itemsets, "confidence", 0.5).collect()
    assert [(r.antecedents, r.consequents) for r in strong] == [(["b"], ["a"])]
    with pytest.raises(ValueError):
        basket.association_rules(itemsets, "cosine", 1.0)


def test_nothing_to_mine(frame):
    assert basket.market_basket(frame(PAIRS), 0.02).count() == 0
    assert basket.market_basket(frame(PAIRS, (1, "a"), (2, "b"), (3, "c")), 0.5).count() == 0


@pytest.fixture
def table(frame):
    return frame(
        "antecedents STRING, consequents STRING, support DOUBLE, confidence DOUBLE, lift DOUBLE",
        ("a", "b", 0.0125, 0.125, 3.25),
        ("c, d", "e", 0.2, 0.875, 2.0),
        ("x", "y", 0.03, 0.5, 2.0),
        *[(f"z{i:02}", "y", 0.03, 0.5, 1.1) for i in range(20)],
    )


def test_business_figures_round_half_to_even(table):
    business = basket.business_rules(table).collect()
    assert len(business) == 15
    first, second = business[0], business[1]
    assert (first.buy_frequency, first.purchase_likelihood, first.strength_score) == (1.2, 12.0, 3.2)
    assert (second.antecedents, second.purchase_likelihood) == ("c, d", 88.0)


def test_texts(table):
    business = basket.business_rules(table)
    insights = basket.rule_insights(business).orderBy("rank").collect()
    assert len(insights) == 5
    assert tuple(insights[1]) == (
        2,
        "Customers who buy: c, d",
        "Also tend to buy: e",
        "88% of customers who bought the first item also bought the second",
        "2.0x",
    )
    texts = [r.text for r in basket.recommendations(business).collect()]
    assert texts == [
        "Place **a** near **b** to increase impulse purchases.",
        "Create a bundle offer: Buy **c, d**, get a discount on **e**.",
        "Send personalized recommendations to customers who bought **x** suggesting **y**.",
        "When stocking **a**, ensure adequate inventory of **b**.",
    ]
    assert tuple(basket.pairing_list(business).first()) == ("a", "b", "12%", "3.2x")


def test_fewer_rules_give_fewer_recommendations(table):
    one = basket.business_rules(table, top=1)
    assert [r.title for r in basket.recommendations(one).collect()] == ["Store Layout", "Inventory Planning"]
