"""Own operators as Spark ML stages."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from raremine.operators import features as FE
from raremine.operators import learners as L
from raremine.operators import stages as SG
from raremine.operators.models import gnb_fit, gnb_predict
from raremine.operators.neighbors import as_vector, knn_vote
from raremine.sources.bundle import load_bundle, save_bundle

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def frame(spark):
    r = np.random.default_rng(6)
    x = r.normal(size=(150, 4)) * [1, 40, 3, 1]
    x[:, 2] = x[:, 0] * 5 + r.normal(size=150) * 0.01            # follows a
    x[:, 3] = 2.0                                                # constant
    y = (x[:, 0] + x[:, 1] / 40 > 0.2).astype(float)
    return spark.createDataFrame([(f"r{i}", float(y[i]), *map(float, x[i])) for i in range(150)],
                                 "id string, label double, a double, b double, c double, d double")


def test_stages_equal_the_operators(frame):
    raw = L.assemble(frame, NAMES, "raw")
    for kind, plain in (("minmax", FE.scale_minmax(frame, NAMES)), ("standard", FE.scale_standard(frame, NAMES))):
        scaled = SG.Scaler(kind=kind).fit(raw).transform(raw)
        got = np.array([r.features.toArray() for r in scaled.orderBy("id").collect()])
        want = np.array([[r[n] for n in NAMES] for r in plain.orderBy("id").collect()])
        assert np.allclose(got, want, atol=1e-12)
    scaled = L.assemble(FE.scale_minmax(frame, NAMES), NAMES)
    kept = SG.CorrelationPruner().fit(scaled)
    assert kept.getOrDefault("positions") == [0, 1, 3]
    nb = SG.GaussianNB().fit(scaled).transform(scaled)
    own = gnb_predict(FE.scale_minmax(frame, NAMES), gnb_fit(FE.scale_minmax(frame, NAMES), NAMES))
    assert {r.id: r.prediction for r in nb.collect()} == {r.id: r.prediction for r in own.collect()}
    near = SG.KNearest(k=3).fit(scaled).transform(scaled)
    v = FE.scale_minmax(frame, NAMES).withColumn("v", as_vector(NAMES))
    assert {r.id: r.prediction for r in near.collect()} == {r.id: r.prediction for r in knn_vote(v, v, 3, "id", "label", "v").collect()}


@pytest.mark.parametrize("last", ["nb", "knn"])
def test_pipeline_is_searched_saved_and_loaded(spark, frame, last):
    raw = L.assemble(frame, NAMES, "raw")
    pruner = SG.CorrelationPruner(inputCol="features", outputCol="kept")
    clf = SG.GaussianNB(featuresCol="kept") if last == "nb" else SG.KNearest(featuresCol="kept")
    pipe = Pipeline(stages=[SG.Scaler(kind="standard"), pruner, clf])
    if last == "nb":
        grid = ParamGridBuilder().addGrid(pruner.threshold, [0.93, 1.5]).build()
        cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=MulticlassClassificationEvaluator(metricName="f1"), numFolds=2, seed=1)
        fitted = cv.fit(raw)
        assert len(fitted.avgMetrics) == 2 and min(fitted.avgMetrics) > 0.7
        model = fitted.bestModel
    else:
        model = pipe.fit(raw)
    path = save_bundle(spark, model, frame, ["label", *NAMES], name=f"own-{last}")
    back, data, names = load_bundle(spark, path)
    again = back.transform(L.assemble(data, names[1:], "raw"))
    want = {r.id: r.prediction for r in model.transform(raw).select("id", "prediction").collect()}
    assert {r.id: r.prediction for r in again.select("id", "prediction").collect()} == want
    assert set(want.values()) == {0.0, 1.0}
    assert again.filter(F.col("prediction") == F.col("label")).count() > 100
