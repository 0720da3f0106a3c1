"""Lineage cuts: tables written to the cluster's shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raremine.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder (never reused)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


#: While a table is written: shuffle files go as soon as the query has ended,
#: and whole texts reach Python workers in batches of bounded size.
WHILE_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
                 "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: computed
    once, however often it is used, and safe against lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = {k: spark.conf.get(k, None) for k in WHILE_WRITING}
    for k, v in WHILE_WRITING.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


#: Entries up to which a written table of ids may be broadcast (some MB).
SMALL = 200_000


def if_small(table: DataFrame, entries=None, limit: int = SMALL) -> DataFrame:
    """A written table, marked for broadcast if it has at most ``limit``
    entries (rows, or the sum of a column expression), so that the large side
    of a join stays where it is; beyond that both sides are shuffled."""
    n = table.agg(F.sum(entries) if entries is not None else F.count(F.lit(1))).first()[0] or 0
    return F.broadcast(table) if n <= limit else table
