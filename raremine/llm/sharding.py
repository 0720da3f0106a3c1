"""Sharding by a Feistel permutation with cycle walking.

Rows get global numbers 0..N-1 that depend on the rows alone (not on files or
partitions).  A keyed balanced Feistel network permutes the smallest domain
[0, 4^b) that holds N; values outside [0, N) walk on along their cycle until
they fall inside, which keeps the mapping a bijection of [0, N).  Permuted
number p means shard p mod S and slot p div S, so shard sizes differ by one row
at most and slots have no gaps.  ``row_of`` inverts it: the row number at any
(shard, slot) is computable without reading the data.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from raremine.llm.textops import mix64

SEED = 20_240_229
ROUNDS = 6
#: Buckets of the numbering; their row counts are all that the driver sees.
BUCKETS = 4096


def _half_bits(n: int) -> int:
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def _round(value: np.ndarray, r: int, seed: int, bits: int) -> np.ndarray:
    key = np.uint64((seed * 0x9E3779B97F4A7C15 + (r + 1) * 0xD6E8FEB86659FD93) & ((1 << 64) - 1))
    return mix64(value ^ key) & np.uint64((1 << bits) - 1)


def _encrypt(x: np.ndarray, bits: int, seed: int, inverse: bool) -> np.ndarray:
    left, right = x >> np.uint64(bits), x & np.uint64((1 << bits) - 1)
    for r in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
        if inverse:
            left, right = right ^ _round(left, r, seed, bits), left
        else:
            left, right = right, left ^ _round(right, r, seed, bits)
    return (left << np.uint64(bits)) | right


def permute(numbers: np.ndarray, n: int, seed: int = SEED, inverse: bool = False) -> np.ndarray:
    """Image of each number of [0, n) under the keyed permutation of [0, n)."""
    bits = _half_bits(n)
    out = _encrypt(np.asarray(numbers, dtype=np.uint64), bits, seed, inverse)
    outside = np.flatnonzero(out >= n)
    while len(outside):
        out[outside] = _encrypt(out[outside], bits, seed, inverse)
        outside = outside[out[outside] >= n]
    return out.astype(np.int64)


def row_of(shard, slot, shards: int, n: int, seed: int = SEED) -> np.ndarray:
    """Row numbers stored at the given (shard, slot) places."""
    return permute(np.asarray(slot) * shards + np.asarray(shard), n, seed, inverse=True)


def number_rows(df: DataFrame, columns: list[str], buckets: int = BUCKETS) -> tuple[DataFrame, int]:
    """``df`` with ``row_number`` 0..N-1 as a function of ``columns`` only, and
    N.  Rows fall into hash buckets; bucket sizes give each bucket's first
    number, and equal rows are counted before they are shuffled, so that any
    number of copies of one row makes one row of the window."""
    bucket = F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")
    rows = df.select(*columns).withColumn("_bucket", bucket)
    counts = {r[0]: r[1] for r in rows.groupBy("_bucket").count().collect()}      # <= buckets rows
    firsts, n = [], 0
    for b in sorted(counts):
        firsts.append((b, n))
        n += counts[b]
    spark = df.sparkSession
    offsets = F.broadcast(spark.createDataFrame(firsts, "_bucket int, _first long"))
    order = Window.partitionBy("_bucket").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    numbered = (rows.groupBy("_bucket", *columns).agg(F.count(F.lit(1)).alias("_copies"))
                .withColumn("_before", F.coalesce(F.sum("_copies").over(order), F.lit(0)))
                .join(offsets, "_bucket")
                .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
                .withColumn("row_number", F.col("_first") + F.col("_before") + F.col("_copy")))
    return numbered.select(*columns, "row_number"), n


def shard_documents(docs: DataFrame, shards: int, seed: int = SEED, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(key, size, text_crc32, row_number, shard, slot): one row per input row.

    Null text has size 16 and the CRC of no bytes; a null key is a key like any
    other; rows equal in key, size and CRC are interchangeable and get a
    number each; an empty table gives an empty result; further columns are
    not read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("_key"), (F.octet_length(body) + 16).cast("long").alias("_size"),
                       F.crc32(body.cast("binary")).alias("_crc"))
    numbered, n = number_rows(rows, ["_key", "_size", "_crc"])

    def place(batches):
        for b in batches:
            p = permute(b.column(3).to_numpy(), n, seed)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array((p % shards).astype(np.int32)), pa.array(p // shards)],
                names=["_key", "_size", "_crc", "row_number", "shard", "slot"])

    kind = docs.schema[key].dataType.simpleString()
    placed = numbered.mapInArrow(place, f"_key {kind}, _size long, _crc long, row_number long, shard int, slot long")
    return placed.select(F.col("_key").alias(key), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
                         "row_number", "shard", "slot")
