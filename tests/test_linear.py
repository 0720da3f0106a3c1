"""Many-split linear models against a fit per split."""

import numpy as np
import pytest

from raremine.operators import linear as LI
from raremine.operators import sampling as S
from raremine.plans.evaluate import eval_shuffle_cv_linear


@pytest.fixture(scope="module")
def frame(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(260, 3)) * [1.0, 5.0, 0.2]
    y = (x @ [1.5, -0.3, 2.0] + r.normal(size=260) * 1.2 > 1.3).astype(float)
    rows = [(f"r{i}", float(y[i]), *map(float, x[i])) for i in range(260)]
    return spark.createDataFrame(rows, "id string, label double, a double, b double, c double")


def objective(loss, w, x, y, s, c):
    z = (2 * y - 1) * (x @ w)
    if loss == "logistic":
        return 0.5 * (w[:-1] ** 2).sum() + c * (s * np.logaddexp(0, -z)).sum()
    return 0.5 * (w ** 2).sum() + c * (s * np.maximum(0, 1 - z) ** 2).sum()


def descend(loss, x, y, s, c):
    """Plain gradient descent with halving: slow, and nothing like Newton."""
    w, step = np.zeros(x.shape[1]), 1.0
    value = objective(loss, w, x, y, s, c)
    eps = 1e-6
    for _ in range(20000):
        g = np.array([(objective(loss, w + eps * e, x, y, s, c) - objective(loss, w - eps * e, x, y, s, c)) / (2 * eps) for e in np.eye(len(w))])
        while step > 1e-14 and objective(loss, w - step * g, x, y, s, c) > value:
            step /= 2
        new = objective(loss, w - step * g, x, y, s, c)
        if value - new < 1e-13:
            break
        w, value, step = w - step * g, new, step * 2
    return w, value


@pytest.mark.parametrize("loss", LI.LOSSES)
def test_every_split_is_fitted_as_if_alone(spark, frame, loss):
    folds, features = 7, ["a", "b", "c"]
    pdf = frame.toPandas()
    test = S.split_strat_shuffle(frame, folds)
    tested = {(r.fold, r.id) for r in test.collect()}
    w = LI.newton_splits(LI.split_rows(frame, features, test), folds, 3, loss, C=0.7)
    for f in (0, 3, 6):
        tr = pdf[[(f, i) not in tested for i in pdf["id"]]]
        x = np.column_stack([tr[features].to_numpy(), np.ones(len(tr))])
        y, s = tr["label"].to_numpy(), np.ones(len(tr))
        _, least = descend(loss, x, y, s, 0.7)
        assert objective(loss, w[f], x, y, s, 0.7) <= least + 1e-7
    pred = {(r.fold, r.id): r.prediction for r in LI.linear_fold_predictions(frame, features, folds, loss, 0.7).collect()}
    assert set(pred) == tested
    by_id = pdf.set_index("id")
    for (f, i), v in pred.items():
        z = by_id.loc[i, features].to_numpy(float) @ w[f][:3] + w[f][3]
        assert abs(z) < 1e-6 or v == float(z > 0)


def test_blocks_of_splits_and_weights(spark, frame, monkeypatch):
    """Splits dealt into blocks give the same weights; so do other partitions."""
    test = S.split_strat_shuffle(frame, 5)
    rows = LI.split_rows(frame, ["a", "b", "c"], test, weights={0.0: 0.6, 1.0: 2.5})
    whole = LI.newton_splits(rows, 5, 3, C=2.0)
    monkeypatch.setattr(LI, "TASK_NUMBERS", 3 * LI.CHUNK_ROWS * 2)
    assert np.allclose(LI.newton_splits(rows.repartition(3), 5, 3, C=2.0), whole, atol=1e-6)
    pdf, tested = frame.toPandas(), {(r.fold, r.id) for r in test.collect()}
    tr = pdf[[(4, i) not in tested for i in pdf["id"]]]
    x = np.column_stack([tr[["a", "b", "c"]].to_numpy(), np.ones(len(tr))])
    s = np.where(tr["label"] == 1, 2.5, 0.6)
    w, least = descend("logistic", x, tr["label"].to_numpy(), s, 2.0)
    assert objective("logistic", whole[4], x, tr["label"].to_numpy(), s, 2.0) <= least + 1e-7


def test_separable_and_constant_columns(spark):
    """Perfectly separated classes (weights held by the penalty), a constant
    and a doubled column: finite weights, right predictions."""
    rows = [(f"k{i}", float(i >= 60), float(i), 1.0, float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "id string, label double, a double, b double, c double")
    for loss in LI.LOSSES:
        out = eval_shuffle_cv_linear(df, ["a", "b", "c"], 6, loss, C=10.0).first()
        assert out["total"] == 60 and out["accuracy"] > 0.95
    with pytest.raises(ValueError):
        LI.newton_splits(None, 1, 1, "hinge")


def test_pca_and_scaling_per_fold(spark, frame):
    """Scores of every fold equal a PCA of that fold's training rows alone."""
    from pyspark.sql import functions as F

    from raremine.operators.features import pca_per_fold, scale_per_fold

    rows = frame.withColumn("fold", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).withColumn(
        "is_test", F.pmod(F.xxhash64("id", "fold"), F.lit(4)) == 0)
    scaled = scale_per_fold(rows, ["a", "b", "c"])
    out, names = pca_per_fold(scaled, ["a", "b", "c"], 0.6)
    got = out.toPandas().sort_values(["fold", "id"])
    plain = rows.toPandas().sort_values(["fold", "id"])
    most = 0
    for f in range(3):
        part = plain[plain["fold"] == f]
        x, train = part[["a", "b", "c"]].to_numpy(), ~part["is_test"].to_numpy()
        x = (x - x[train].mean(axis=0)) / x[train].std(axis=0)
        centred = x - x[train].mean(axis=0)
        _, sv, vt = np.linalg.svd(centred[train], full_matrices=False)
        most = max(most, int((np.cumsum(sv ** 2 / (sv ** 2).sum()) < 0.6).sum()) + 1)
        vt = vt * np.sign(vt[np.arange(3), np.abs(vt).argmax(axis=1)])[:, None]
        want = centred @ vt.T
        assert np.allclose(got[got["fold"] == f][names].to_numpy(), want[:, :len(names)], atol=1e-9)
    assert len(names) == most


def test_learning_curve_with_pca(spark, frame):
    from raremine.plans.evaluate import learning_curve_gnb

    plain = learning_curve_gnb(frame, ["a", "b", "c"], k=3, granularity=3).orderBy("size").toPandas()
    turned = learning_curve_gnb(frame, ["a", "b", "c"], k=3, granularity=3, scale=True, center=True, pca=2).orderBy("size").toPandas()
    assert list(plain["size"]) == list(turned["size"]) and turned["val_mean"].between(0, 1).all()
    assert not np.allclose(plain["val_mean"], turned["val_mean"])
