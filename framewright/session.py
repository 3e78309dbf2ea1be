"""Session construction and lineage cutting.

On a cluster the session comes from the caller; ``spark.checkpoint.dir`` names a
shared folder that survives executor loss. Only when it is unset (local tests) do we
create a scratch folder of our own.
"""

from __future__ import annotations

import logging
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: int | None = None, app: str = "framewright", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks. Cluster users pass their own session."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cores
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FW_DRIVER_MEMORY", "16g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # analysis errors still raise; this only stops the JSON echo of each one on stderr
    logging.getLogger("DataFrameQueryContextLogger").setLevel(logging.CRITICAL)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, honouring ``spark.checkpoint.dir`` when the cluster sets it."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="fw-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by a Parquet table of a name of its own in the checkpoint folder, read back with ``df``'s schema."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss).

    The frame is cached while it is checkpointed: the checkpoint files are written by a
    second job, which would otherwise compute the whole plan again."""
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist()
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def materialize(result: DataFrame, cached: list[DataFrame]) -> DataFrame:
    """Checkpoint an iterative operator's result, then release the intermediates it cached,
    so a long session does not accumulate cached blocks."""
    out = cut_lineage(result)
    for frame in cached:
        frame.unpersist()
    return out
