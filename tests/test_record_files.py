"""One record a file, written and read by tasks."""

import json
import os

from pyspark.sql import functions as F

from raremine.session import scratch_path
from raremine.sources import record_files as RF


def test_round_trip(spark):
    rows = [("a.txt", "one\ntwo\r\n"), ("a.txt", "same name"), ("b@x.org", ""), ("c / d%?", "slash é\U0001f600"), ("e", None)]
    path = scratch_path(spark, "records")
    RF.write_records(spark.createDataFrame(rows, "name string, value string").repartition(2), path)
    back = sorted((r.name, r.value) for r in RF.read_records(spark, path).collect())
    assert back == sorted((n, v or "") for n, v in rows)


def test_many_files_and_few_folders(spark):
    path = scratch_path(spark, "records")
    df = spark.range(900).select(F.concat(F.lit("m"), "id").alias("name"), F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")).alias("value"))
    RF.write_records(df.repartition(6), path)
    local = path.removeprefix("file:")
    assert len([x for x in os.listdir(local) if x.startswith("part-")]) == 6
    assert RF.read_records(spark, path).agg(F.count("name"), F.sum(F.length("value"))).first()[0] == 900


def test_only_committed_attempts_count(spark):
    path = scratch_path(spark, "records")
    RF.write_records(spark.createDataFrame([("a", "1"), ("b", "2")], "name string, value string").coalesce(1), path)
    local = path.removeprefix("file:")
    os.makedirs(f"{local}/part-lost/0")
    with open(f"{local}/part-lost/0/a", "w") as f:
        f.write("left by a lost task")
    assert sorted(r.value for r in RF.read_records(spark, path).collect()) == ["1", "2"]
    assert len(json.load(open(f"{local}/_committed.json"))) == 1


def test_empty(spark):
    path = scratch_path(spark, "records")
    RF.write_records(spark.createDataFrame([], "name string, value string"), path)
    assert RF.read_records(spark, path).count() == 0
