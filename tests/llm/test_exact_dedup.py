from __future__ import annotations

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from martlet.llm.exact_dedup import drop_exact_duplicates, exact_duplicates


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[lowered(text)].append(i)
    seen, found = set(), []
    for i, text in rows:
        key = lowered(text)
        known = [x for x in groups[key] if x is not None]
        keep = max(known) if known else None
        stays = i == keep and (key, i) not in seen
        seen.add((key, i))
        digest = hashlib.sha256(key.encode()).hexdigest()
        found.append((i, keep, len(groups[key]), stays, digest))
    return sorted(found, key=str)


CASES = [
    (1, "Same"), (2, "sAME"), (3, "same"), (3, "SAME"), (4, None), (5, ""), (6, "Élan"),
    (7, "élan"), (8, "İ"), (9, "i̇"), (None, "same"), (None, "alone"), (None, "alone"),
    (10, "x" * 200_000), (11, "X" * 200_000), (12, "a\x00b"), (13, " same"),
]


def test_equals_brute_force(texts):
    got = sorted(map(tuple, exact_duplicates(texts(*CASES)).collect()), key=str)
    assert got == brute(CASES)


def test_colliding_digests_are_told_apart_by_content(texts):
    """With a digest that nearly everything shares, contents alone decide."""
    weak = lambda content: F.substring(F.sha2(content, 256), 1, 0)
    got = exact_duplicates(texts(*CASES), digest=weak).drop("text_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted((r[:4] for r in brute(CASES)), key=str)
    kept = drop_exact_duplicates(texts(*CASES), digest=weak)
    assert kept.count() == sum(r[3] for r in brute(CASES))


def test_dropping_keeps_rows_whole(texts):
    docs = texts(*CASES).withColumn("digest", F.lit(1)).withColumn("_own_digest", F.lit("mine"))
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r["_own_digest"] for r in kept.collect()} == {"mine"}
    want = sorted((r[0] for r in brute(CASES) if r[3]), key=str)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == want


def test_one_hot_text_and_an_empty_table(spark, texts):
    hot = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), "id")).alias("text")
    )
    got = exact_duplicates(hot).where("group_size > 1")
    assert got.count() == 1000 and got.where("kept").collect()[0]["doc_id"] == 2997
    assert exact_duplicates(texts()).count() == 0
    assert drop_exact_duplicates(texts()).count() == 0


def test_main_path_is_native(documents):
    plan = exact_duplicates(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
