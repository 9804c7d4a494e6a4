"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the plans here rely on.  Partition counts are left to the cluster: AQE
# coalesces small shuffle partitions and splits skewed ones at run time.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HTML rows are wide, so Arrow batches are kept short and bounded in bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def local_session(cpus: int | str = 8, app: str = "factloom", **conf: str) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(cpus) if str(cpus).isdigit() else "8",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, below ``spark.checkpoint.dir``.

    A local folder is used only when the setting is absent and the session
    itself is local; a cluster without the setting is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not (spark.conf.get("spark.master", "") or "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix=f"{purpose}-")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a narrow table that several branches of a job read, and read it
    back: the work above it runs once and its files outlive any executor."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
