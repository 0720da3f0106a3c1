"""Joins that stay balanced when one key holds a large share of the rows.

``salted_join`` joins a large table to a per-key table (one or a few rows per
key: codes, ranks, vocabulary statistics, labels).  Keys of the large side
that hold more than ``1 / (4 * partitions)`` of its rows are "hot": their rows
get a salt in [0, salts) from a hash of the row, and only the hot keys' rows
of the small side are replicated once per salt.  A hot key is then processed
by ``salts`` tasks instead of one; cold keys join as usual (salt 0).

Finding the hot keys is one partial aggregate of the large side; at most
4 * partitions keys can be hot, so that list is a proven-small broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, keys: Sequence[str], fraction: float | None = None) -> DataFrame | None:
    """Keys holding more than ``fraction`` of the rows (default 1/(4P)), as a
    small frame ``(*keys, _hot)``; None when there is none."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    fraction = fraction if fraction is not None else 1.0 / (4 * parts)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    if total == 0:
        return None
    hot = counts.filter(F.col("_n") > F.lit(total * fraction)).select(*keys).collect()   # <= 1/fraction rows
    if not hot:
        return None
    schema = counts.select(*keys).schema
    return spark.createDataFrame([tuple(r) for r in hot], schema).withColumn("_hot", F.lit(True))


def hot_keys_from_counts(small: DataFrame, keys: Sequence[str], count_col: str,
                         fraction: float | None = None) -> DataFrame | None:
    """Hot keys read off a per-key count already held by the small side
    (e.g. a document frequency or a value count): no pass over the big side."""
    spark = small.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    fraction = fraction if fraction is not None else 1.0 / (4 * parts)
    total = small.agg(F.sum(count_col)).first()[0] or 0
    if total == 0:
        return None
    hot = small.filter(F.col(count_col) > F.lit(total * fraction)).select(*keys).collect()
    if not hot:
        return None
    return spark.createDataFrame([tuple(r) for r in hot], small.select(*keys).schema).withColumn("_hot", F.lit(True))


def salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner",
                salts: int | None = None, fraction: float | None = None,
                count_col: str | None = None) -> DataFrame:
    """``big.join(small, keys, how)`` with hot keys of ``big`` split over
    ``salts`` tasks (default: the shuffle partition count).  ``how`` is
    'inner' or 'left' (rows of ``big`` are never duplicated or dropped).
    ``count_col``: a column of ``small`` holding each key's row count in
    ``big`` (or a proxy of it), used to find hot keys without scanning
    ``big``; it is dropped from the result."""
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    keys = list(keys)
    if count_col is not None:
        hot = hot_keys_from_counts(small, keys, count_col, fraction)
        small = small.drop(count_col)
    else:
        hot = hot_keys(big, keys, fraction)
    if hot is None:
        return big.join(small, keys, how)
    spark = big.sparkSession
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    row_hash = F.xxhash64(*[F.col(c) for c in big.columns])
    big_s = (big.join(F.broadcast(hot), keys, "left")
             .withColumn("_salt", F.when(F.col("_hot"), F.pmod(row_hash, F.lit(salts))).otherwise(F.lit(0)))
             .drop("_hot"))
    small_s = (small.join(F.broadcast(hot), keys, "left")
               .withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                                              .otherwise(F.array(F.lit(0)))))
               .drop("_hot"))
    return big_s.join(small_s, keys + ["_salt"], how).drop("_salt")
