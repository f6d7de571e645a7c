from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlet.llm import mixing

TARGETS = {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2}


def totals(frame, weight):
    rows = frame.collect()
    return sum(np.array(r["posterior"]) * r["n_tokens"] * r[weight] for r in rows)


def test_meets_the_targets_and_keeps_every_document(documents):
    got = mixing.mixing_rates(documents, documents, TARGETS, least=1.0).cache()
    assert got.count() == documents.count()
    assert got.where("rate < 1 or copies < 1 or abs(rate - copies) >= 1").count() == 0
    domains = sorted(TARGETS)
    wanted = np.array([TARGETS[d] for d in domains])
    shares = totals(got, "rate")
    assert np.allclose(shares / shares.sum(), wanted, atol=0.01)
    drawn = totals(got, "copies")
    assert np.allclose(drawn / drawn.sum(), wanted, atol=0.03)
    named = got.join(documents.select("doc_id", "lang"), "doc_id")
    assert named.where("domain = lang").count() > 0.97 * named.count()
    mixed = mixing.mix(documents, documents, TARGETS, least=1.0)
    assert mixed.columns == documents.columns
    want = {r["doc_id"]: r["copies"] for r in got.collect()}
    assert dict(mixed.groupBy("doc_id").count().collect()) == want


@pytest.mark.parametrize("least", [0.0, 0.5])
def test_equals_brute_force_least_squares(spark, least):
    """On soft members, the steps reach the same gap as plain projected gradient in numpy."""
    rng = np.random.default_rng(3)
    soft = rng.dirichlet([0.5, 0.5, 0.5], 300)
    tokens = rng.integers(1, 200, 300)
    rows = [(int(n), [float(v) for v in p]) for n, p in zip(tokens, soft, strict=True)]
    members = spark.createDataFrame(rows, "n_tokens long, posterior array<double>")
    targets, budget = {"a": 0.6, "b": 0.3, "c": 0.1}, float(tokens.sum())
    plan = mixing.fit_rates(
        members, ["a", "b", "c"], targets, least=least, budget=budget, tolerance=1e-4, most_steps=200
    )
    rates = plan.rates(soft)
    assert rates.min() >= least
    wanted = np.array([0.6, 0.3, 0.1]) * budget
    gap = soft.T @ (tokens * rates) - wanted
    brute, size = np.ones(300), tokens @ (soft**2).sum(axis=1)
    for _ in range(20_000):
        brute = np.maximum(least, brute - soft @ (soft.T @ (tokens * brute) - wanted) / size)
    best = soft.T @ (tokens * brute) - wanted
    assert np.abs(gap).max() <= np.abs(best).max() + 2e-3 * budget


@pytest.mark.parametrize("shares", [(0.7, 0.2, 0.09, 0.01), (0.9, 0.05, 0.04, 0.01), (0.8, 0.1, 0.08, 0.02)])
def test_a_scarce_domain_meets_its_target(spark, shares):
    """A domain of 1 % of the tokens is brought to 20 %, by the rates and by the column."""
    rng = np.random.default_rng(5)
    home = rng.choice(4, 2000, p=shares)
    soft = 0.97 * np.eye(4)[home] + 0.03 * rng.dirichlet([0.3] * 4, 2000) * np.eye(4)[home]
    soft /= soft.sum(axis=1, keepdims=True)
    tokens = rng.integers(50, 150, 2000)
    rows = [(int(n), [float(v) for v in p]) for n, p in zip(tokens, soft, strict=True)]
    members = spark.createDataFrame(rows, "n_tokens long, posterior array<double>")
    plan = mixing.fit_rates(members, ["en", "de", "es", "fr"], TARGETS, least=1.0)
    rates = plan.rates(soft)
    got = soft.T @ (tokens * rates)
    assert rates.min() >= 1
    assert np.allclose(got / got.sum(), [0.4, 0.2, 0.2, 0.2], atol=0.001)
    assert plan.optimal and np.abs(plan.gap).max() < 0.001 and plan.passes < 40
    column = members.select(plan.column(F.col("n_tokens"), F.col("posterior")).alias("r"), "posterior")
    for r in column.limit(50).collect():
        assert r["r"] == pytest.approx(plan.rates(np.array([r["posterior"]]))[0])


def test_targets_out_of_reach_are_reported(spark, caplog):
    """Where a bound keeps a gap open, the gap is the least there is, and it is told."""
    rng = np.random.default_rng(6)
    soft, tokens = rng.dirichlet([0.4, 0.4, 0.4], 200), rng.integers(1, 200, 200)
    rows = [(int(n), [float(v) for v in p]) for n, p in zip(tokens, soft, strict=True)]
    members = spark.createDataFrame(rows, "n_tokens long, posterior array<double>")
    budget = float(tokens.sum())
    plan = mixing.fit_rates(members, ["a", "b", "c"], {"a": 0.9, "b": 0.1}, least=0.5, budget=budget)
    wanted = np.array([0.9, 0.1, 0.0]) * budget
    gap = soft.T @ (tokens * plan.rates(soft)) - wanted
    brute, size = np.ones(200), tokens @ (soft**2).sum(axis=1)
    for _ in range(50_000):
        brute = np.maximum(0.5, brute - soft @ (soft.T @ (tokens * brute) - wanted) / size)
    best = soft.T @ (tokens * brute) - wanted
    assert plan.optimal and np.allclose(plan.gap, gap / budget, atol=1e-9)
    assert np.abs(best).max() > 0.05 * budget
    assert np.linalg.norm(gap) <= np.linalg.norm(best) * 1.001
    slope, free = soft @ gap, plan.rates(soft) > 0.5
    close = 0.002 * 0.1 * budget
    assert np.abs(slope[free]).max() <= close and slope[~free].min() >= -close
    assert "targets missed" in caplog.text


def test_budget_and_unreachable_targets(documents):
    half = mixing.mixing_rates(documents, documents, {"en": 1.0}, budget=10_000.0, least=0.0)
    tokens = totals(half, "rate")
    assert tokens[sorted(TARGETS).index("en")] == pytest.approx(10_000, rel=0.02)
    none = mixing.mixing_rates(documents, documents, {"xx": 1.0}, least=1.0)
    assert none.where("rate <> 1").count() == 0


def test_edge_cases(texts):
    rows = [(1, None), (2, ""), (3, "the and of"), (3, "the and of"), (None, "der und"), (4, "w " * 90_000)]
    docs = texts(*rows).withColumn("posterior", F.lit("mine")).withColumn("_times", F.lit("mine"))
    plain = mixing.mixing_rates(docs, docs, TARGETS, least=1.0).collect()
    assert len(plain) == 6 and {r["rate"] for r in plain} == {1.0} and {r["copies"] for r in plain} == {1}
    taught = docs.withColumn("lang", F.when(F.col("text").contains("der"), "de").otherwise("en"))
    got = mixing.mixing_rates(docs, taught, TARGETS, least=1.0).collect()
    assert {r["rate"] for r in got if r["doc_id"] in (1, 2)} == {1.0}
    assert len({r["rate"] for r in got if r["doc_id"] == 3}) == 1
    mixed = mixing.mix(docs, taught, TARGETS, least=1.0)
    assert mixed.columns == docs.columns and mixed.count() >= 6
    assert mixing.mixing_rates(texts(), texts(), TARGETS).count() == 0
    assert mixing.mix(texts(), texts(), TARGETS).count() == 0
