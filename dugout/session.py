"""Session defaults: adaptive execution, UTC and a shuffle width that suits the cores at hand."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "dugout", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the library is tested with; settings that the cluster already names win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    cores = os.cpu_count() or 8
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which the driver and all executors share; in local mode it may be this machine's own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: Stored bytes and rows of a table that one partition of parts_of() stands for. Rows are counted too, as writers pack
#: them unlike: the same line may take 18 bytes or 9.
PART_BYTES = 4 << 20
PART_ROWS = 220_000


def parts_of(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Partitions in proportion to a stored table, so that a task's share of it doesn't grow; as many as the cores at least."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return max(spark.sparkContext.defaultParallelism, -(-size // PART_BYTES), -(-table(spark, sf_dir, name).count() // PART_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str):
    """One parquet table of a data folder, through Spark's readers (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
