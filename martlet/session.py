"""Session helpers: a local session for tests, and the shared folder for checkpoints."""

from __future__ import annotations

import json
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("martlet")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor reaches, as the cluster names it in ``spark.checkpoint.dir``.

    Where it is unset, one that was set on the context is used. Only a local master may fall
    back on a temporary folder: on a cluster the other machines would not see it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="martlet-"))
    return context.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from the files.

    Parquet rather than a row checkpoint: later passes read only the columns they need, and a
    lost executor costs a file read instead of the whole computation.
    """
    path = f"{shared_folder(df.sparkSession)}/martlet-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """A list for materialised tables whose files go when the block ends."""
    held: list[DataFrame] = []
    try:
        yield held
    finally:
        for df in held:
            for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
                remove_folder(spark, folder)


def remove_folder(spark: SparkSession, path: str, encoded: bool = False) -> None:
    """Delete a folder on whatever file system holds it; ``encoded`` paths are URIs."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path) if encoded else path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a stream's checkpoint: the same one after each restart."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
