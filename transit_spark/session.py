"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("transit_spark")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # Small test data would otherwise be coalesced into one task per stage.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-warehouse-"))
        .getOrCreate()
    )


def work_dir(spark: SparkSession) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session that names none may use a temporary folder of its machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/transit-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="run-transit-")
    raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back.

    For results that are read more than once: they are computed once, a lost executor does not
    bring the whole history back, and later reads still prune columns and push filters down.
    """
    target = f"{path or work_dir(df.sparkSession)}/stage"
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def stage_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stages independent frames side by side."""
    if not frames:
        return {}
    with ThreadPoolExecutor(len(frames)) as pool:
        return dict(zip(frames, pool.map(stage, frames.values())))
