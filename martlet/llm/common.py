"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a data folder."""
    hold_few_texts(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def hold_few_texts(spark: SparkSession, rows: int = 1000) -> None:
    """Let Python tasks hold this many rows at a time: texts are long, and some very long.

    Sets the session's Arrow batch size, unless it is smaller already.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def in_fold(key: str, folds: int, fold: int) -> Column:
    """True where crc32 of the key as text leaves ``fold``; a null key is in no fold (false)."""
    rest = F.pmod(F.crc32(F.col(key).cast("string")), F.lit(folds))
    return F.coalesce(rest == fold, F.lit(False))


def learnable(key: str, folds: int, fold: int) -> Column:
    """True for rows that a model may learn from: a known key outside the held-out fold."""
    return F.col(key).isNotNull() & ~in_fold(key, folds, fold)


def bounded_sample(rows: DataFrame, label: str, key: str, most: int) -> DataFrame:
    """At most ``most`` rows of each label, the same ones on every run over the same table.

    Rows are drawn by a hash of the key at a rate that suits the label's count, so no task meets
    more than about the rows that are wanted, whatever the table's size. The number of labels
    is taken to be small: their counts reach the driver.
    """
    counts = rows.groupBy(label).count().collect()
    turn = F.xxhash64(F.lit(20_240), F.col(key))
    share = F.lit(1.0)
    for value, count in counts:
        own = F.lit(min(1.0, 1.25 * most / count))
        share = F.when(F.col(label).eqNullSafe(F.lit(value)), own).otherwise(share)
    drawn = rows.where(F.pmod(turn, F.lit(1 << 30)) < share * (1 << 30))
    rest = [F.col(c) for c in rows.columns if c not in (label, key)]
    order = Window.partitionBy(label).orderBy(turn, key, *rest)
    place = drawn.withColumn("_place", F.row_number().over(order))
    return place.where(F.col("_place") <= most).orderBy(label, "_place").drop("_place")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where ``df`` has a column of that name already."""
    taken = {column.lower() for column in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def own_columns(df: DataFrame) -> list[Column]:
    """All columns of ``df`` by name, whatever characters the names hold."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]
