"""Model bundle sink/source: classifier + dataset + ordered feature list.

Written under the shared ``spark.checkpoint.dir`` (never a machine-local
folder): the fitted Spark ML model with its own writer, the dataset as
Parquet and the feature list (label first) as one-row JSON.
"""

from __future__ import annotations

import importlib
import json

from pyspark.sql import DataFrame, SparkSession

from raremine.session import scratch_path


def save_bundle(spark: SparkSession, model, data: DataFrame, feature_list, name: str = "model") -> str:
    path = scratch_path(spark, f"bundle-{name}")
    model.write().overwrite().save(f"{path}/model")
    data.write.mode("overwrite").parquet(f"{path}/data")
    meta = {"features": list(feature_list), "class": type(model).__module__ + "." + type(model).__name__}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(f"{path}/meta")
    return path


def load_bundle(spark: SparkSession, path: str):
    """(model, dataset DataFrame, feature list)."""
    meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    mod, cls = meta["class"].rsplit(".", 1)
    model = getattr(importlib.import_module(mod), cls).load(f"{path}/model")
    return model, spark.read.parquet(f"{path}/data"), meta["features"]
