from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from martlet.llm import quality
from martlet.llm.common import in_fold
from martlet.llm.linear import fit_lasso, logistic

LABELS = "/root/testdata/sf0.01/labels.parquet"


def test_held_out_accuracy(spark, documents):
    labels = spark.read.parquet(LABELS)
    held = in_fold("doc_id", 4, 2)
    got = quality.score_quality(documents, labels, held_out=held)
    assert got.count() == documents.count()
    rows = got.join(labels, "doc_id").collect()
    out = [r for r in rows if r["held_out"]]
    assert len(out) > 50
    assert np.mean([r["predicted"] == r["quality"] for r in out]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_compiled_rules_equal_numpy(documents):
    measured = documents.select("doc_id", quality.with_statistics(F.col("text")).alias("s"))
    frame = measured.select("doc_id", "s.*").toPandas().sort_values("doc_id")
    values = frame[list(quality.STATISTICS)].to_numpy()
    target = (values[:, 4] > np.median(values[:, 4])).astype(float)
    model = quality.fit_rules(values, target, np.ones(len(values)))
    assert 0 < len(model.weights)
    scored = measured.select("doc_id", "s.*").select("doc_id", model.column().alias("score"))
    got = scored.toPandas().sort_values("doc_id")["score"].to_numpy()
    assert np.allclose(got, model.scores(values), atol=1e-12)


def test_lasso_drops_what_says_nothing():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 6))
    y = (rng.random(2000) < logistic(2 * x[:, 0] - 1)).astype(float)
    bias, weights = fit_lasso(x, y, np.ones(2000), 0.02)
    assert weights[0] > 1 and np.abs(weights[1:]).max() < 0.05 and bias < 0


def test_labels_of_held_out_rows_teach_nothing(spark, documents):
    labels, held = spark.read.parquet(LABELS), in_fold("doc_id", 4, 2)
    wrong = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    docs = documents.where("doc_id < 400")
    first = quality.score_quality(docs, labels, held_out=held).collect()
    assert sorted(first) == sorted(quality.score_quality(docs, wrong, held_out=held).collect())


def test_edge_cases(spark, texts):
    rows = [(1, None), (2, ""), (2, ""), (3, "x" * 200_000), (None, "words here"), (4, "\n\n")]
    docs = texts(*rows).withColumn("words", F.lit("mine")).withColumn("score", F.lit("mine"))
    held = in_fold("doc_id", 4, 2)
    schema = "doc_id long, quality int, toxic int"
    for labels, score in (([], 0.5), ([(1, 1, 0)], 1.0), ([(1, None, 0), (None, 1, 1)], 0.5)):
        got = quality.score_quality(docs, spark.createDataFrame(labels, schema), held_out=held).collect()
        assert len(got) == 6 and all(abs(r["score"] - score) < 1e-4 for r in got)
    assert quality.statistics(None) == quality.statistics("")
    none = spark.createDataFrame([], schema)
    assert quality.score_quality(texts(), none, held_out=held).count() == 0
