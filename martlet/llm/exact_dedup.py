"""Exact duplicate documents by skew-safe combining, in DataFrame operations only.

Texts are equal when they are identical after lower-casing A-Z. Copies are combined in three
steps, each of which groups by the digest *and* the full content, so that equal digests never
decide alone: tasks combine what they read (the partial aggregate), salted digest groups merge
those, and the winners of all salts of a digest are combined at the end. A text that a third of
all rows share therefore arrives as one row per task and salt, wherever it is merged.

Defined results: a null text counts as empty and equals the empty text. A null ``doc_id`` loses
against any other and only stays if all rows of its group have none. Rows that repeat both
``doc_id`` and text count one by one, and exactly one of the rows of the winning id stays. An
empty table gives no rows. Other columns, whatever their names, take no part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import fresh, lower_ascii, own_columns
from martlet.session import materialise

SALTS = 16


def content_digest(content: Column) -> Column:
    return F.sha2(content, 256)


def _contents(docs: DataFrame, id_col: str, text_col: str, digest: Callable) -> DataFrame:
    """(id, content, digest) of every row."""
    content = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("id"), content.alias("content"))
    return rows.withColumn("digest", digest(F.col("content")))


def copy_groups(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per content: ``digest, content, keep_id, group_size``."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    merged = salted.groupBy("digest", "salt", "content").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    # Dealt by the digest alone, so that what follows per digest needs no further shuffle.
    return (
        merged.repartition("digest")
        .groupBy("digest", "content")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    )


def _winners(rows: DataFrame, salts: int) -> tuple[DataFrame, list[str]]:
    """The groups, and the columns that tell them apart.

    That is the digest as long as no two contents share one, which the combining has compared in
    full; then the contents need not be moved a third time. Else it is digest and content.
    """
    groups = copy_groups(rows, salts)
    by_digest = materialise(
        groups.groupBy("digest").agg(
            F.count(F.lit(1)).alias("contents"),
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
        )
    )
    if by_digest.where("contents > 1").isEmpty():
        return by_digest.drop("contents"), ["digest"]
    return groups, ["digest", "content"]


def exact_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = content_digest,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    rows = _contents(docs, id_col, text_col, digest)
    groups, key = _winners(rows, salts)
    members = rows.groupBy("id", *key).agg(F.count(F.lit(1)).alias("copies"))
    each = members.join(groups, key).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    )
    return each.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_exact_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = content_digest,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = _contents(docs, id_col, text_col, digest)
    groups, key = _winners(rows, salts)
    content = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    own = fresh(docs, *[f"_own_{name}" for name in key])
    theirs = fresh(docs, *[f"_kept_{name}" for name in key], "_kept_id")
    kept = groups.select(*[F.col(a).alias(b) for a, b in zip([*key, "keep_id"], theirs, strict=True)])
    made = {"digest": digest(content), "content": content}
    keyed = docs.withColumns({name: made[k] for name, k in zip(own, key, strict=True)})
    same = F.col(id_col).eqNullSafe(F.col(theirs[-1]))
    for mine, other in zip(own, theirs, strict=False):
        same = same & (F.col(mine) == F.col(other))
    stay = keyed.join(kept, same, "left_semi")
    # Only rows that repeat the winner's id and text are left to drop.
    return stay.dropDuplicates([id_col, *own]).select(*own_columns(docs))
