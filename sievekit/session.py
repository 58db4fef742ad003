"""Session helpers: a sane local session for tests/bench, and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "sievekit", conf: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and bench; ``conf``
    adds settings to a fresh one.

    On a cluster the session already exists and is returned untouched
    (``getOrCreate``); the options below only apply to a fresh local JVM.
    """
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    shuffle_partitions = shuffle_partitions or cpus
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SIEVEKIT_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only invent one when unset.

    On a cluster this setting names shared storage, which is what makes a
    reliable checkpoint survive executor loss.  A private temporary folder
    is created only for local runs where nothing is configured.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions manage checkpoints server-side
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="sievekit-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame, how: str = "checkpoint", row_group: int | None = None) -> DataFrame:
    """Cut lineage between dependent statistic passes.

    ``checkpoint`` writes the frame as Parquet to the shared checkpoint folder
    (the plan below it is dropped, and the data survives executor loss), in row groups
    of ``row_group`` bytes if given;
    ``persist`` keeps it in memory/disk with lineage for recomputation;
    ``none`` returns the frame untouched (small plans, unit tests).
    """
    if how == "none":
        return df
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        # one pass: a written table, which Spark reads back column by column
        path = f"{ensure_checkpoint_dir(df.sparkSession)}/{uuid.uuid4().hex}"
        (df.write.option("parquet.block.size", row_group) if row_group else df.write).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    raise ValueError(f"unknown materialize mode {how!r}")
