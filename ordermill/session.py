"""Session helpers. Operators never set a master: the cluster's own configuration decides it."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "ordermill") -> SparkSession:
    """Session with the settings results depend on (UTC) and runtime re-planning switched on."""
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named in ``spark.checkpoint.dir``; invent one only in local mode."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return
    if context.getCheckpointDir() is not None:
        return
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ordermill-checkpoint-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, for plans that several passes read. Survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
