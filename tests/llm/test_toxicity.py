from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from martlet.llm import toxicity
from martlet.llm.common import in_fold

SCHEMA = "doc_id long, quality int, toxic int"


def planted(spark, n=600):
    """Clean prose of invented words, and toxic documents that hold some of five bad words."""
    rng = random.Random(9)
    parts = ["ra", "lo", "mi", "ten", "sol", "ve", "du", "kar"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(1, 5)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(5, 200))]
        bad = i % 4 == 0
        for _ in range(rng.randrange(1, 6) if bad else 0):
            insult = rng.choice(["Zork", "grulf", "zorkish", "blemmo", "Grulfen"])
            words.insert(rng.randrange(len(words)), insult)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, SCHEMA)


def test_planted_words_are_found(spark):
    docs, labels = planted(spark)
    held = in_fold("doc_id", 3, 1)
    rows = toxicity.score_toxicity(docs, labels, held_out=held).join(labels, "doc_id").collect()
    assert len(rows) == 600
    assert all(r["predicted"] == r["toxic"] for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_accuracy(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = in_fold("doc_id", 3, 1)
    got = toxicity.score_toxicity(docs.join(labels.select("doc_id"), "doc_id"), labels, held_out=held)
    out = got.where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in out]) > 0.95


def test_label_model_weighs_copies_of_a_voter_down():
    """Ten copies of a poor voter count about as much as one."""
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.5
    voter = lambda right: np.where(rng.random(4000) < right, truth, ~truth) * 2 - 1
    good, poor = [voter(0.85) for _ in range(4)], voter(0.6)
    model = toxicity.fit_label_model(np.stack([*good, *[poor] * 10], axis=1), 0.5)
    assert model.weights[4:].sum() < 1.5 and model.weights[:4].min() > 0.5
    guess = model.posterior(np.stack([*good, *[poor] * 10], axis=1)) >= 0.5
    assert np.mean(guess == truth) > 0.88


def test_reader_counts_entries():
    reader = toxicity.Reader(toxicity.Lexicon.of("zork", "gru*", "grulf"))
    row = reader.features("Zork, ZORK! grulf x grulfen")
    assert np.allclose(row[len(toxicity.PATTERNS) :], np.log1p([2, 2, 1]))
    assert not reader.features(None).any() and not reader.features("").any()
    folded = toxicity.Reader(toxicity.Lexicon([["zor*", "zork"], ["blem"]], [0, 0], [0.0]))
    assert np.allclose(folded.features("zork blem zorro")[len(toxicity.PATTERNS) :], [np.log(3) / 2 + np.log(2) / 2 + np.log(2)])
    assert folded.features("zorro")[0] == 1 and folded.found("zorro")[1] == (0,)


def test_mining_equals_brute_force(spark):
    """Counts, folding and the share of chance, from plain loops over the sample."""
    docs, labels = planted(spark, 300)
    sample = docs.join(labels, "doc_id").select("doc_id", "text", F.col("toxic").alias("label"))
    rows = [(r["text"], r["label"]) for r in sample.collect()]
    held = {}
    for i, (text, _) in enumerate(rows):
        for word in set(toxicity._WORD.findall(text.lower())):
            for token in toxicity.tokens_of(word):
                held.setdefault(token, set()).add(i)
    bad = {i for i, (_, label) in enumerate(rows) if label}
    folded = {}
    for token, at in held.items():
        if len(at) >= 2:
            folded.setdefault(frozenset(at), []).append(token)
    chance, kept = len(bad) / len(rows), []
    for at, tokens in folded.items():
        n, t = len(at), len(at & bad)
        same = [len(o & bad) for o in folded if len(o) == n]
        tail = sum(math.comb(n, k) * chance**k * (1 - chance) ** (n - k) for k in range(t, n + 1))
        pure = t / chance >= 0.98 * (t / chance + (n - t) / (1 - chance))
        if pure and len(same) * tail <= 0.25 * sum(o >= t for o in same):
            kept.append(sorted(tokens))
    got = toxicity.mine_lexicon(sample, len(bad), len(rows) - len(bad), purity=0.98, false_share=0.25)
    assert sorted(got.entries) == sorted(kept) and any("zork" in e for e in kept)


def test_label_model_equals_plain_steps():
    """The posterior after some rounds, from loops over documents and voters."""
    rng = np.random.default_rng(6)
    given = rng.integers(-1, 2, (200, 5))
    got = toxicity.fit_label_model(given, 0.3, rounds=4)

    def own(errors):
        n = len(errors)
        cross = [[sum(e[i] * e[j] for e in errors) / n + (1e-6 if i == j else 0) for j in range(5)] for i in range(5)]
        return [1 / sum((cross[i][j] / math.sqrt(cross[i][i] * cross[j][j])) ** 2 for j in range(5)) for i in range(5)]

    rows = given.astype(float).tolist()
    mean = [sum(r[i] for r in rows) / 200 for i in range(5)]
    weight = own([[r[i] - mean[i] for i in range(5)] for r in rows])
    said = [sum(r[i] * weight[i] for i in range(5)) for r in rows]
    toxic = [0.5 + 0.48 * ((v > 0) - (v < 0)) for v in said]
    for _ in range(4):
        odds = []
        for i in range(5):
            right = sum(p if r[i] > 0 else 1 - p for r, p in zip(rows, toxic) if r[i])
            share = min(0.98, max(0.02, (right + 0.7) / (sum(abs(r[i]) for r in rows) + 1)))
            odds.append(math.log(share / (1 - share)))
        errors = [list(r) for r in rows]
        for side in (True, False):
            some = [k for k, p in enumerate(toxic) if (p >= 0.5) == side]
            for i in range(5):
                middle = sum(rows[k][i] for k in some) / max(1, len(some))
                for k in some:
                    errors[k][i] -= middle
        weight = own(errors)
        toxic = [
            1 / (1 + math.exp(-(math.log(0.3 / 0.7) + sum(r[i] * odds[i] * weight[i] for i in range(5)))))
            for r in rows
        ]
    assert np.allclose(got.posterior(given), toxic, atol=1e-6)


def test_a_long_tailed_vocabulary_is_found(spark):
    """400 bad words without common beginnings, two in each toxic document, long tailed prose."""
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    parts = ["an", "the", "re", "on", "is", "ed", "ble", "wh", "st", "or", "ing", "tion"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(1, 6)))
    bad = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 10))) for _ in range(400)]
    rows, labels = [], []
    for i in range(6000):
        words = [word() for _ in range(rng.randrange(20, 150))]
        toxic = i % 4 == 0
        for insult in rng.sample(bad, 2) if toxic else ():
            words.insert(rng.randrange(len(words)), insult)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(labels, SCHEMA)
    scored = toxicity.score_toxicity(docs, table, held_out=in_fold("doc_id", 3, 1))
    out = scored.where("held_out").join(table, "doc_id").collect()
    caught = [r["predicted"] for r in out if r["toxic"]]
    alarms = [r["predicted"] for r in out if not r["toxic"]]
    assert np.mean(caught) >= 0.9 and np.mean(alarms) <= 0.03


def test_edge_cases(spark, texts):
    rows = [(1, None), (2, ""), (2, ""), (3, "x " * 100_000), (None, "zork"), (4, "zork zork")]
    docs = texts(*rows).withColumn("score", F.lit("mine")).withColumn("id", F.lit("mine"))
    held = in_fold("doc_id", 3, 1)
    none = spark.createDataFrame([], SCHEMA)
    for labels in ([], [(4, 1, 1)], [(4, 1, None), (None, 1, 1), (3, 1, 0)]):
        frame = spark.createDataFrame(labels, SCHEMA)
        got = toxicity.score_toxicity(docs, frame, held_out=held).collect()
        assert len(got) == 6 and {r["score"] for r in got} == {0.0}
    assert toxicity.score_toxicity(texts(), none, held_out=held).count() == 0
    planted_docs, labels = planted(spark, 200)
    taught = toxicity.train_toxicity_model(
        planted_docs.withColumnRenamed("doc_id", "id"),
        labels.select(F.col("doc_id").alias("id"), F.col("toxic").alias("label")),
    )
    scores = docs.select("doc_id", toxicity.toxicity_score(F.col("text"), taught).alias("s")).collect()
    assert [r["s"] >= 0.7 for r in scores] == [False, False, False, False, True, True]
