"""Cross-engine helpers: the same value in Spark and in DuckDB."""

import math

import pytest
from pyspark.sql import functions as F

from raremine.functions.numeric import det_round, fmt_duration, hash_key, hash_uniform, linspace_int
from raremine.plans.oracle import det_round_sql

VALUES = [0.1250875, -0.0000004, -0.0000007, 2.5e-7, 1234567.8912345, 1e10 / 3, -1e-12, 0.0, -0.0,
          1e13, -1e13, 9.3e12, float("inf"), -float("inf"), None]


def test_det_round_equals_duckdb(spark, duck):
    df = spark.createDataFrame([(v,) for v in VALUES], "x double")
    got = [r.y for r in df.select(det_round(F.col("x"), 6).alias("y")).collect()]
    sql = det_round_sql("SELECT round(x, 6) AS y FROM (SELECT unnest(?) AS x)")
    want = [r[0] for r in duck.execute(sql, [VALUES]).fetchall()]
    assert got == want


def test_det_round_sql_rewrites_nested_calls():
    out = det_round_sql("SELECT round(a + round(b, 2), 6) AS r, around(x, 1) FROM t")
    assert "round(" not in out.replace("around(", "")
    assert "around(x, 1)" in out


def test_md5_uniform_equals_duckdb(spark, duck):
    df = spark.createDataFrame([(i, f"id{i}") for i in range(50)], "f int, id string")
    got = [(r.h, r.u) for r in df.select(hash_key(42, F.col("f"), F.col("id")).alias("h"),
                                         hash_uniform(42, F.col("f"), F.col("id")).alias("u")).collect()]
    want = duck.execute(
        "SELECT md5(concat_ws('|', '42', CAST(f AS VARCHAR), id)) AS h,"
        " CAST(('0x' || substr(md5(concat_ws('|', '42', CAST(f AS VARCHAR), id)), 1, 8)) AS BIGINT)"
        " / CAST(4294967296 AS DOUBLE) AS u FROM (SELECT unnest(range(50)) AS f) t,"
        " LATERAL (SELECT 'id' || CAST(f AS VARCHAR) AS id)").fetchall()
    assert got == [tuple(r) for r in want]
    assert all(0.0 <= u < 1.0 for _, u in got)


def test_fmt_duration_and_linspace(spark):
    df = spark.createDataFrame([(3725.25,)], "d double")
    assert df.select(fmt_duration(F.col("d")).alias("s")).first().s == "1:2:5.3"
    sizes = spark.range(1).select(linspace_int(20, 1349.1, 10).alias("a")).first().a
    import numpy as np
    assert sizes == [int(v) for v in np.linspace(20, 1349.1, 10)]
