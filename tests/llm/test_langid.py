from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martlet.llm import langid
from martlet.llm.common import bounded_sample, in_fold


def test_held_out_accuracy(documents):
    held = in_fold("doc_id", 4, 2)
    got = langid.identify_language(documents, held_out=held)
    rows = got.join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == documents.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    out = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in out]) > 0.95


def test_held_out_rows_teach_nothing(documents):
    """Other labels in the held-out rows change no prediction."""
    held = in_fold("doc_id", 4, 2)
    docs = documents.where("doc_id < 300")
    wrong = docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))
    first = langid.identify_language(docs, held_out=held, per_language=40).collect()
    second = langid.identify_language(wrong, held_out=held, per_language=40).collect()
    assert sorted(first) == sorted(second)


def test_tables_equal_the_plain_convolution():
    rng = np.random.default_rng(0)
    model = langid.fit_network(["der und die", "the and of"] * 20, ["de", "en"] * 20, epochs=1)
    rows = langid._padded([bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (256, 40, 1)])
    pooled = []
    for width in langid.WIDTHS:
        embedded = model.embedding[rows]
        sums = sum(
            embedded[:, k : k + langid.WINDOW] @ model.filters[width][k] for k in range(width)
        )
        pooled.append(sums.max(axis=1) + model.bias[width])
    features = np.maximum(np.hstack(pooled), 0)
    want = langid._softmax(features @ model.dense + model.dense_bias)
    assert np.allclose(langid.Scorer(model).windows(rows), want, atol=1e-4)


def test_long_text_equals_its_windows():
    model = langid.fit_network(["der und die", "the and of"] * 20, ["de", "en"] * 20, epochs=30)
    scorer = langid.Scorer(model)
    text = "the and of " * 110_000
    (_, both), (_, alone) = scorer.texts([text, "der"]), scorer.texts([text])
    assert np.isclose(both[0], alone[0]) and scorer.texts([text])[0] == ["en"]


def test_edge_cases(texts, spark):
    held = in_fold("doc_id", 4, 2)
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, "the"), (4, "the"), (None, "und")]
    docs = texts(*rows).withColumn("lang_pred", F.lit("mine")).withColumn("_language", F.lit(1))
    got = langid.identify_language(docs, held_out=held).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}  # no labels at all
    taught = docs.withColumn("lang", F.when(F.col("text") == "the", "en").otherwise("de"))
    model = langid.train_language_model(taught, eligible=F.col("doc_id").isNotNull())
    assert model.languages == ["de", "en"]
    found = docs.select("doc_id", langid.predict_language(F.col("text"), model).alias("p"))
    assert [r["p"]["lang_pred"] for r in found.where("doc_id < 4").collect()] == ["und"] * 3
    kept = langid.keep_identified(docs, model, least=0.0)
    assert kept.columns == docs.columns and kept.count() == 3
    assert langid.identify_language(texts(), held_out=held).count() == 0


def test_bounded_sample(spark):
    rows = spark.range(5000).select(
        F.col("id").alias("key"), F.when(F.col("id") < 40, "few").otherwise("many").alias("label")
    )
    got = bounded_sample(rows, "label", "key", 50)
    counts = dict(got.groupBy("label").count().collect())
    assert counts["few"] == 40 and 30 <= counts["many"] <= 50
    again = bounded_sample(rows.repartition(7), "label", "key", 50)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))


FOREIGN = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах.",
    "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια",
    "人人生而自由在尊严和权利上一律平等他们赋有理性和良心",
    "for (int i = 0; i < n; ++i) { buf[i] = ptr->x ^ 0xFF; }",
    "xqzj kvwq zzxk qjwp vbkx wqzj xkcd qwzx jjkq",
]


@pytest.mark.parametrize("languages", [("de", "en", "es", "fr"), ("de", "en")])
def test_foreign_and_noise_texts_go_and_clean_ones_stay(spark, documents, texts, languages):
    """The pipeline's filter rejects what no learned language has, however many there are."""
    clean = documents.where(F.col("lang").isin(*languages))
    rows = [(-1 - i, text) for i, text in enumerate(FOREIGN)]
    rows += [(-101 - i, f"{text} " * 40) for i, text in enumerate(FOREIGN)]
    got = corpus_pipeline.language_id(spark, clean.unionByName(texts(*rows)), "")
    kept = {r["doc_id"] for r in got.select("doc_id").collect()}
    assert [text for i, text in rows if i in kept] == []
    lettered = clean.where("text rlike '[a-zA-Z]'").select("doc_id", "n_chars").collect()
    lost = [r["doc_id"] for r in lettered if r["doc_id"] not in kept]
    assert len(lost) <= 0.005 * len(lettered)
    assert not [r["doc_id"] for r in lettered if r["n_chars"] < 60 and r["doc_id"] in lost]


def test_a_text_in_two_languages_is_known():
    """With a rejection class, the score is the share of all languages together."""
    rng = np.random.default_rng(4)
    some = lambda words: " ".join(rng.choice(words, 30))
    de, en = ["der", "und", "nicht", "ist"], ["the", "and", "of", "with"]
    pairs = [(some(de), "de") for _ in range(80)] + [(some(en), "en") for _ in range(80)]
    model = langid.fit_network([t for t, _ in pairs], [n for _, n in pairs], rejects=True)
    assert model.languages == ["de", "en"] and len(model.dense_bias) == 3
    names, scores = langid.Scorer(model).texts([some(de) + " " + some(en), some(de), "жзъы щюя"])
    assert names[1] == "de" and scores[:2].min() > 0.9 and scores[2] < 0.5
