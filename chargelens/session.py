"""Session defaults. Static settings belong to spark-submit; these are the runtime ones."""
from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a shuffle starts in many parts that are joined up to this size, so what a task holds does not grow with the input
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # skewed sort-merge / shuffled-hash partitions are split at run time
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Korean code pages of the usage export
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, app: str = "chargelens", memory: str = "12g") -> SparkSession:
    """Session for tests and bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint dir, or a new local one when a local master has none."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"master {master}: set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = _LOCAL.setdefault("dir", "") or tempfile.mkdtemp(prefix="chargelens-", dir="/tmp")
        _LOCAL["dir"] = path
    return path


def stage(df: DataFrame, row_group: int | None = None) -> DataFrame:
    """Write an intermediate table that several branches of a plan read, and read it back.

    The branches then scan the table instead of each repeating the work, the lineage is cut at files that outlive any
    executor, and later joins know the real size. `row_group` bounds the bytes that a reader of wide rows holds at once.
    """
    if getattr(df, "_chargelens_staged", False):
        return df
    path = f"{shared_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.options(**({} if row_group is None else {"parquet.block.size": row_group})).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._chargelens_staged = True
    return out
