"""Session defaults and the shared folder for materialised intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, partitions: int = 8, app: str = "estrato",
                  **extra: str) -> SparkSession:
    """A single-JVM session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: there the
    driver and the executors are one process on one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = getattr(spark, "_estrato_shared_dir", None)
    if root is None:
        root = "file:" + tempfile.mkdtemp(prefix="estrato-")
        spark._estrato_shared_dir = root
    return root


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> int:
    """Delete the intermediates that this session has written below the shared
    folder; the number of them. To be called when a job's results are written."""
    made, spark._estrato_made = getattr(spark, "_estrato_made", []), []
    for path in made:
        _delete(spark, path)
    return len(made)


def discard(*frames: DataFrame) -> None:
    """Delete intermediates, as :func:`materialise` gave them, that nothing reads any more."""
    for df in frames:
        _delete(df.sparkSession, df._estrato_path)
        df.sparkSession._estrato_made.remove(df._estrato_path)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage with a written table: it outlives lost executors, and
    later passes read only the columns they touch."""
    spark = df.sparkSession
    path = new_path(spark, label)
    if not hasattr(spark, "_estrato_made"):
        spark._estrato_made = []
    spark._estrato_made.append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._estrato_path = path
    return out
