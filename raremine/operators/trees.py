"""Fitted boosted trees as tables: nodes, split counts, staged margins.

Spark saves a tree ensemble as one Parquet row per node.  Read back, that
table answers what the model object does not: how often each feature splits,
and the margin after every boosting round (tree prefixes), from which scores
per round follow.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raremine import SEED

#: The fit stops at the first round whose gain on the validation rows is below
#: this share of their loss (GBTClassifier.validationTol).
VALIDATION_TOL = 0.001


def fit_boosted(train: DataFrame, features: Sequence[str], label: str = "label", key: str = "id", max_iter: int = 50,
                max_depth: int = 3, step: float = 0.05, validation_share: float | None = 0.1, tol: float = VALIDATION_TOL,
                seed: int = SEED):
    """GBTClassifier with early stopping: the ``validation_share`` rows of
    smallest md5 key are kept out of the fit, and the model ends at the round
    from which their loss no longer falls by ``tol``."""
    from raremine.operators.learners import assemble, make_estimator
    from raremine.operators.sampling import split_holdout

    est = make_estimator("boosted_trees", label, maxDepth=max_depth, stepSize=step, maxIter=max_iter)
    if validation_share:
        train = split_holdout(train, validation_share, seed, key).withColumnRenamed("is_test", "_validation")
        est.setParams(validationIndicatorCol="_validation", validationTol=tol)
    return est.fit(train if "features" in train.columns else assemble(train, features))


def tree_nodes(model, spark) -> DataFrame:
    """(tree, weight, node, feature, threshold, left, right, prediction, gain)
    of a fitted GBTClassificationModel; leaves have feature -1.  Written to
    the shared scratch folder by Spark ML's own writer and read as Parquet."""
    from raremine.session import scratch_path

    path = scratch_path(spark, "trees")
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    body = "nodeData" if "nodeData" in data.columns else None
    col = (lambda c: F.col(f"{body}.{c}")) if body else F.col
    weights = spark.createDataFrame(list(enumerate(float(w) for w in model.treeWeights)), "tree int, weight double")
    nodes = data.select(F.col("treeID").cast("int").alias("tree"), col("id").alias("node"), col("split.featureIndex").alias("feature"),
                        F.get(col("split.leftCategoriesOrThreshold"), F.lit(0)).alias("threshold"), col("leftChild").alias("left"),
                        col("rightChild").alias("right"), col("prediction").alias("prediction"), col("gain").alias("gain"),
                        col("split.numCategories").alias("_categories"))
    nodes = nodes.withColumn("feature", F.when(F.col("left") < 0, F.lit(-1)).otherwise(F.col("feature")).cast("int"))
    bad = nodes.filter((F.col("feature") >= 0) & (F.col("_categories") >= 0)).limit(1).count()
    if bad:
        raise ValueError("categorical splits are not read")
    return nodes.drop("_categories").join(F.broadcast(weights), "tree").select(      # one row per tree
        "tree", "weight", "node", "feature", "threshold", "left", "right", "prediction", "gain")


def split_counts(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, importance): how many nodes split on each feature; features
    that no node uses are left out."""
    names = nodes.sparkSession.createDataFrame(list(enumerate(features)), "_i int, name string")
    counts = nodes.filter("feature >= 0").groupBy("feature").agg(F.count(F.lit(1)).alias("importance"))
    return counts.join(F.broadcast(names), counts.feature == names._i).select(F.col("name").alias("feature"), "importance")


def staged_margins(df: DataFrame, nodes: DataFrame, features: str = "features", out: str = "margins") -> DataFrame:
    """Adds ``out``: the running margin after each tree (array, one entry per
    round).  The nodes of an ensemble are a few numbers per tree."""
    table = nodes.orderBy("tree", "node").toPandas()
    trees = []
    for _, t in table.groupby("tree"):
        n = int(t["node"].max()) + 1
        arrays = {c: np.full(n, -1 if c in ("feature", "left", "right") else 0.0) for c in ("feature", "threshold", "left", "right", "prediction")}
        at = t["node"].to_numpy()
        for c in arrays:
            arrays[c][at] = t[c].fillna(0).to_numpy()
        trees.append((float(t["weight"].iloc[0]), arrays["feature"].astype(int), arrays["threshold"], arrays["left"].astype(int),
                      arrays["right"].astype(int), arrays["prediction"]))

    def margins(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=object)
        v = np.stack(x.to_numpy())
        rows = np.arange(len(v))
        total = np.zeros(len(v))
        stages = np.empty((len(v), len(trees)))
        for k, (weight, feature, threshold, left, right, prediction) in enumerate(trees):
            at = np.zeros(len(v), int)
            while (feature[at] >= 0).any():
                inner = feature[at] >= 0
                go = v[rows, np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(go, left[at], right[at]), at)
            total = total + weight * prediction[at]
            stages[:, k] = total
        return pd.Series(list(stages))

    udf = F.pandas_udf(margins, "array<double>")
    return df.withColumn(out, udf(vector_to_array(F.col(features))))


def auc_per_round(df: DataFrame, nodes: DataFrame, group: Sequence[str] = (), label: str = "label", features: str = "features") -> DataFrame:
    """(*group, round, auc): the AUC of the margins after every round."""
    from raremine.operators.metrics import roc_auc

    staged = staged_margins(df, nodes, features).select(*group, label, F.posexplode("margins").alias("_i", "score"))
    staged = staged.withColumn("round", F.col("_i") + 1)
    return roc_auc(staged, label, "score", [*group, "round"])
