"""Session helpers: one place for the configuration every entry point shares."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "raremine",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Create (or reuse) a session with AQE on, the UI off and UTC time."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RAREMINE_DRIVER_MEMORY", "4g"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when it is unset
    (local tests) create a scratch folder of our own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="raremine-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder (never reused, so
    runs do not overwrite each other)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df, name: str):
    """``df`` written once as Parquet in the shared scratch folder and read
    back: every later use reads columns of files (with honest sizes), and a
    lost executor costs nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (survives
    executor loss), never a local one.  The frame is persisted while it is
    written so the checkpoint does not compute it a second time."""
    ensure_checkpoint_dir(df.sparkSession)
    df.persist()
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()
