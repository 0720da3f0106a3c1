"""Models of all splits fitted or searched in the same jobs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from raremine.operators import learners as L
from raremine.operators import linear as LI
from raremine.operators import neighbors as NB
from raremine.operators import sampling as S


@pytest.fixture(scope="module")
def frame(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(260, 3)) * [1.0, 5.0, 0.2] + [3.0, 0.0, 0.1]
    y = (x @ [1.5, -0.3, 2.0] + r.normal(size=260) * 1.2 > 5.5).astype(float)
    rows = [(f"r{i}", float(y[i]), *map(float, x[i]), 2.5) for i in range(260)]
    return spark.createDataFrame(rows, "id string, label double, a double, b double, c double, flat double")


def test_hinge_splits_goes_the_way_of_spark_ml(spark, frame):
    features = ["a", "b", "c", "flat"]
    test = S.split_strat_shuffle(frame, 3)
    w, paths = LI.hinge_splits(LI.split_rows(frame, features, test), 3, 4, C=1.0)
    for f in range(3):
        train = frame.join(test.filter(F.col("fold") == f).select("id"), "id", "left_anti")
        _, _, model = L.fit_predict("linear_svc", train, train, features, C=1.0)
        history = model.summary().objectiveHistory
        assert np.allclose(paths[f][:8], history[:8], rtol=1e-6)
        assert paths[f][-1] == pytest.approx(history[-1], rel=1e-3)
        assert w[f][3] == 0.0 and np.allclose(w[f][:3], model.coefficients.toArray()[:3], rtol=0.05, atol=0.02)


def test_many_partitions_of_sums(spark, frame, monkeypatch):
    test = S.split_strat_shuffle(frame, 2)
    rows = LI.split_rows(frame, ["a", "b", "c"], test)
    whole, _ = LI.hinge_splits(rows, 2, 3, regParam=0.1, max_iter=8)
    monkeypatch.setattr(LI, "PACK_BYTES", 1000)
    monkeypatch.setattr(LI, "DRIVER_PARTS", 1)
    assert np.allclose(LI.hinge_splits(rows, 2, 3, regParam=0.1, max_iter=8)[0], whole, atol=1e-6)


@pytest.mark.parametrize("more", [4, 8])
def test_vote_of_all_splits_from_one_search(spark, more):
    """As a search in each split; with few neighbours kept, some are searched
    again.  Keys and rows repeat."""
    r = np.random.default_rng(2)
    x = np.round(r.normal(size=(150, 2)), 1)
    rows = [(f"k{i % 140}" if i % 30 else "k0", float(r.integers(0, 2)), v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id string, label double, v array<double>").localCheckpoint()
    test = spark.createDataFrame([(f, f"k{i}") for f in range(4) for i in range(140) if (i * 7 + f) % 3 == 0], "fold int, id string")
    every = df.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(3))))
    train, tested = every.join(test, ["fold", "id"], "left_anti"), every.join(test, ["fold", "id"], "left_semi")
    near = NB.knn_join(df, df, more, exclude_self=False)
    for asked in (train, tested):
        once = NB.knn_vote(asked, df, 4, group="fold", tested=test, folds=4, near=near)
        each = NB.knn_vote(asked, train, 4, group="fold")
        key = lambda a: tuple((v is not None, v) for v in (a["fold"], a["id"], a["label"], a["prediction"]))
        assert sorted(map(key, once.collect())) == sorted(map(key, each.collect()))


def test_compare_models_fits_and_searches_all_folds_together(spark, frame, monkeypatch):
    from raremine.plans import catalog_models as CM

    seen = []
    for module, name in ((L, "fit_predict"), (NB, "knn_join")):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, _f=real, _n=name, **k: seen.append((_n, a[0] if _n == "fit_predict" else "")) or _f(*a, **k))
    out = {r.model: r for r in CM.compare_models(spark, frame, ["a", "b", "c"], folds=3, models=["linear_svc", "knn"]).collect()}
    assert set(out) == {"linear_svc", "knn"} and out["linear_svc"].test_f1_mean > 0.5
    assert sorted(seen) == [("fit_predict", "linear_svc"), ("knn_join", "")]
