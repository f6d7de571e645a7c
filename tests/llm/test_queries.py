from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from martlet.llm import exact_dedup, queries, simhash

DATA = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    numbers = [name.split("_")[0] for name in queries.QUERIES]
    assert sorted(numbers) == sorted(f"op{n}" for n in range(1, 14))
    registered = __spark_entry__.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(registered)
    assert set(__spark_entry__.oracle_sql()) <= set(registered)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, name):
    base = duckdb.connect()
    for table in ("documents", "conversations"):
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    got = queries.QUERIES[name](spark, DATA)
    want = base.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name.replace(" ", "_"))
        stage(spark, docs, DATA).write.parquet(out)
        kept[name] = (docs, spark.read.parquet(out))
        docs = kept[name][1]
    for name, (_, after) in list(kept.items())[:-1]:
        assert after.columns == columns, name
    before, after = kept["language ID"]
    assert after.count() >= 0.99 * before.where("text rlike '[a-zA-Z]'").count()
    before, after = kept["exact dedup"]
    assert after.count() == exact_dedup.exact_duplicates(before).where("kept").count()
    before, after = kept["SimHash near-dedup"]
    groups = simhash.near_duplicates(before)
    assert after.count() == groups.select("component_id").distinct().count()
    before, after = kept["mixing to target weights"]
    assert after.select("doc_id").distinct().count() == before.count()
    before, after = kept["SentencePiece"]
    assert after.count() == before.count() and after.where("not exact").count() == 0
    assert corpus_pipeline.run(spark, DATA).where("not exact").count() == 0


def test_pipeline_on_odd_tables(spark, texts, tmp_path):
    """Nulls, empty and long texts, repeated rows, clashing columns; no labels; no rows."""
    plain = "the cat sat on the mat and looked at the dog in the garden "
    rows = [(i, plain + f"number {i} of many words that differ {i * 7}") for i in range(20)]
    rows += [(30, None), (31, ""), (32, plain.upper() * 400), (33, "twice " + plain), (33, "twice " + plain), (None, plain)]
    odd = texts(*rows).withColumns({"copies": F.lit("mine"), "fingerprint": F.lit("mine"), "_language": F.lit("x")})
    empty = texts()
    for name, docs in (("odd", odd), ("empty", empty)):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        got = corpus_pipeline.run(spark, folder)
        assert got.where("exact IS NOT NULL AND NOT exact").count() == 0
        ids = {r["doc_id"] for r in got.collect()}
        # Nothing is learned without labels, so stage 1 keeps all; copies and near copies go.
        assert ids <= {i for i, _ in rows} and (name == "odd") == bool(ids)
        if name == "odd":
            assert {30, 31} & ids and 32 in ids and got.where("doc_id = 33").count() <= 1
