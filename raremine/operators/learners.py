"""Spark ML classifiers behind one small interface, plus the feature models
that wrap ``pyspark.ml`` (PCA with explicit centring, random Fourier features
for the kernel SVC re-aim, polynomial expansion).

Every fit is a distributed Spark ML job on a DataFrame with a ``features``
vector column; per-fold loops only iterate over a handful of folds/params
(driver holds parameters, never rows).
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence

import numpy as np
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       NaiveBayes, RandomForestClassifier)
from pyspark.ml.feature import PCA, PolynomialExpansion, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raremine import SEED


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def make_estimator(name: str, label: str = "label", weight: str | None = None, **params):
    """Estimators named as in the reference's model list."""
    common = {"featuresCol": "features", "labelCol": label}
    if name == "logistic":
        est = LogisticRegression(maxIter=params.get("maxIter", 100), regParam=params.get("regParam", 0.0),
                                 standardization=False, **common)
    elif name == "linear_svc":
        est = LinearSVC(maxIter=params.get("maxIter", 100), regParam=params.get("regParam", 0.0), **common)
    elif name == "random_forest":
        est = RandomForestClassifier(numTrees=params.get("numTrees", 20), maxDepth=params.get("maxDepth", 5),
                                     impurity="gini", seed=SEED, **common)
    elif name == "boosted_trees":
        est = GBTClassifier(maxDepth=params.get("maxDepth", 3), stepSize=params.get("stepSize", 0.05),
                            maxIter=params.get("maxIter", 20), seed=SEED, **common)
    elif name == "gaussian_nb":
        est = NaiveBayes(modelType="gaussian", **common)
    else:
        raise ValueError(name)
    if weight is not None and hasattr(est, "setWeightCol"):
        est.setWeightCol(weight)
    return est


#: Models whose regularisation is given as C.
LINEAR = ("logistic", "linear_svc")


def fit_predict(name: str, train: DataFrame, test: DataFrame, features: Sequence[str],
                label: str = "label", key: str = "id", splits: int = 0, **params):
    """Fit on ``train``, predict ``test``: ((key, label, prediction), fit
    seconds, model).  ``C`` (inverse regularisation strength of the reference's
    linear models) maps to Spark's ``regParam = 1 / (C * n_train)``;
    ``balanced`` weighs each row by n / (classes * rows of its class).

    With ``splits`` (linear_svc), ``train`` holds all rows once and ``test`` the test
    rows of so many splits, with their ``fold``: each split's model is fitted on the
    rows whose key it does not test, all of them in the same jobs.  Returns
    ((fold, key, label, prediction) of the test rows, fit seconds of a split, the
    same of the training rows)."""
    if splits:
        return _fit_predict_splits(name, train, test, features, label, key, splits, **params)
    if "C" in params:
        c = params.pop("C")
        params["regParam"] = 1.0 / (c * max(train.count(), 1))
    weight = None
    if params.pop("balanced", False):
        from raremine.operators.sampling import class_weight_balanced

        weight = "class_weight"
        train = class_weight_balanced(train, label, weight)
    est = make_estimator(name, label, weight, **params)
    t0 = time.time()
    model = est.fit(assemble(train, features))
    fit_s = time.time() - t0
    pred = model.transform(assemble(test, features))
    return pred.select(key, label, F.col("prediction").cast("double")), fit_s, model


def _fit_predict_splits(name: str, rows: DataFrame, test: DataFrame, features: Sequence[str], label: str, key: str, splits: int,
                        C: float | None = None, regParam: float = 0.0):
    from raremine.operators import linear as LI
    from raremine.session import written

    if name != "linear_svc":
        raise ValueError(f"{name} is fitted split by split")
    tested = test.groupBy(key).agg(F.collect_set("fold").alias("tested"))        # bounded by the number of splits
    x = F.array(*[F.col(f).cast("double") for f in features]).alias("x")
    rows = written(rows.select(key, label, x).join(tested, key, "left")
                   .withColumn("tested", F.coalesce("tested", F.array().cast("array<int>"))), "svc-splits")
    t0 = time.time()
    weights, _ = LI.hinge_splits(rows.withColumn("y", F.col(label)), splits, len(features), C, regParam)
    fit_s = (time.time() - t0) / splits
    trained = F.array_except(F.sequence(F.lit(0), F.lit(splits - 1)), "tested")
    return (LI.score_splits(test.select(key, label, x, F.array("fold").alias("folds")), weights, key, label), fit_s,
            LI.score_splits(rows.withColumn("folds", trained), weights, key, label))


# ------------------------------------------------------------------ PCA ----

def pca_fit(df: DataFrame, features: Sequence[str], n_components=None):
    """Centred PCA.  ``n_components``: None = all, int, or a variance share in
    (0, 1) (the least k reaching it).  Returns (model, means, k, explained)."""
    means_row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in features]).first()
    means = [means_row[c] for c in features]
    centred = df.select(*[(F.col(c).cast("double") - F.lit(m)).alias(c) for c, m in zip(features, means)],
                        *[c for c in df.columns if c not in set(features)])
    p = len(features)
    full = PCA(k=p, inputCol="features", outputCol="pcs").fit(assemble(centred, features))
    explained = list(full.explainedVariance.toArray())
    if n_components is None:
        k = p
    elif isinstance(n_components, float) and n_components < 1:
        cum, k = 0.0, p
        for i, v in enumerate(explained):
            cum += v
            if cum >= n_components - 1e-12:
                k = i + 1
                break
    else:
        k = int(n_components)
    return full, means, k, explained


def pca_transform(df: DataFrame, features: Sequence[str], model, means, k: int,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Scores on the first k axes (ML transform of the centred vector); each
    axis signed so that its largest |loading| is positive."""
    from pyspark.ml.functions import vector_to_array

    pc = model.pc.toArray()
    signs = [1.0 if pc[np.argmax(np.abs(pc[:, i])), i] >= 0 else -1.0 for i in range(pc.shape[1])]
    centred = df.select(*keep, *[(F.col(c).cast("double") - F.lit(m)).alias(c) for c, m in zip(features, means)])
    scores = model.transform(assemble(centred, features)).withColumn("_a", vector_to_array("pcs"))
    return scores.select(*keep, *[(F.col("_a")[i] * F.lit(signs[i])).alias(f"pc{i + 1}") for i in range(k)])


# ------------------------------------------------------ kernel SVC re-aim ----

def random_fourier_features(df: DataFrame, features: Sequence[str], n_out: int = 64,
                            gamma: float = 0.1, seed: int = SEED, prefix: str = "rff") -> DataFrame:
    """Approximate RBF kernel map z(x) = sqrt(2/D) cos(w.x + b), w ~ N(0, 2*gamma),
    b ~ U(0, 2pi); w and b are D x (p+1) numbers drawn from a seeded generator
    (driver, O(columns)), the map itself is a column expression."""
    rng = np.random.default_rng(seed)
    p = len(features)
    w = rng.normal(0.0, math.sqrt(2 * gamma), size=(n_out, p))
    b = rng.uniform(0.0, 2 * math.pi, size=n_out)
    scale = math.sqrt(2.0 / n_out)
    # one parsed text per number: a column made call by call takes the driver 450 calls
    x = ["CAST(`" + c.replace("`", "``") + "` AS DOUBLE)" for c in features]
    cols = [F.expr(f"{scale!r}D * cos({float(b[i])!r}D + " + " + ".join(f"{v} * ({float(w[i, j])!r}D)" for j, v in enumerate(x)) + ")")
            .alias(f"{prefix}{i}") for i in range(n_out)]
    keep = [c for c in df.columns if c not in set(features)]
    return df.select(*keep, *cols), [f"{prefix}{i}" for i in range(n_out)]


def polynomial_features(df: DataFrame, features: Sequence[str], degree: int = 2) -> DataFrame:
    """Polynomial kernel re-aim: explicit expansion as a vector column."""
    return PolynomialExpansion(degree=degree, inputCol="features", outputCol="poly").transform(
        assemble(df, features))


def md5_grid_sample(grid: list[dict], n: int, seed: int = SEED) -> list[dict]:
    """Seeded sample of a parameter grid (random search): md5 order of the
    combination's text, first n."""
    import hashlib

    keyed = sorted(grid, key=lambda g: hashlib.md5(f"{seed}|{sorted(g.items())}".encode()).hexdigest())
    return keyed[:n]


def selector_pipeline(name: str, num_top: int, label: str = "label", **params):
    """Pipeline(F-test feature selector, classifier) -- the reference's
    SelectKBest + classifier pipeline on a ``raw`` vector column."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import UnivariateFeatureSelector

    sel = UnivariateFeatureSelector(featuresCol="raw", outputCol="features", labelCol=label,
                                    selectionMode="numTopFeatures")
    sel.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(num_top)
    return Pipeline(stages=[sel, make_estimator(name, label, **params)]), sel
