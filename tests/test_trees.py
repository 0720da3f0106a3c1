"""Boosted trees read back as tables."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from raremine.operators import learners as L
from raremine.operators import trees as TR
from raremine.plans.catalog_models import boost_round_cv

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    r = np.random.default_rng(9)
    x = r.normal(size=(400, 3))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0.8)) ^ (r.random(400) < 0.15)
    return spark.createDataFrame([(f"r{i}", float(y[i]), *map(float, x[i])) for i in range(400)],
                                 "id string, label double, a double, b double, c double")


@pytest.fixture(scope="module")
def model(frame):
    return TR.fit_boosted(frame, FEATURES, max_iter=8, validation_share=None)


def walk(tree):
    """Split features of one tree, from its printed form."""
    return [int(line.split("feature ")[1].split(" ")[0]) for line in tree.toDebugString.split("\n") if "If (feature" in line]


def test_split_counts_equal_a_walk_over_the_trees(spark, model):
    want = {}
    for t in model.trees:
        for f in walk(t):
            want[FEATURES[f]] = want.get(FEATURES[f], 0) + 1
    got = {r.feature: r.importance for r in TR.split_counts(TR.tree_nodes(model, spark), FEATURES).collect()}
    assert got == want and all(v > 0 for v in got.values())


def test_staged_margins_equal_the_model(spark, frame, model):
    data = L.assemble(frame, FEATURES)
    nodes = TR.tree_nodes(model, spark)
    rows = TR.staged_margins(model.transform(data), nodes).select("rawPrediction", "margins").collect()
    for r in rows:
        assert len(r.margins) == 8 and abs(r.margins[-1] - r.rawPrediction[1]) < 1e-9
    first = model.trees[0]
    alone = {r.id: r.prediction for r in first.transform(data).select("id", "prediction").collect()}
    staged = {r.id: r.margins[0] for r in TR.staged_margins(data, nodes).select("id", "margins").collect()}
    assert all(abs(staged[i] - alone[i] * model.treeWeights[0]) < 1e-9 for i in alone)


def test_last_round_has_the_models_auc(spark, frame, model):
    scored = model.transform(L.assemble(frame, FEATURES))
    want = BinaryClassificationEvaluator(labelCol="label").evaluate(scored)
    got = {r["round"]: r["auc"] for r in TR.auc_per_round(L.assemble(frame, FEATURES), TR.tree_nodes(model, spark)).collect()}
    assert sorted(got) == list(range(1, 9)) and abs(got[8] - want) < 1e-6


def test_rounds_over_folds(frame):
    rows = {r["round"]: r for r in boost_round_cv(frame, FEATURES, k=3, max_iter=6).collect()}
    assert sorted(rows) == list(range(1, 7))
    assert rows[6].train_auc > rows[6].test_auc > 0.6
    losses = [rows[i].train_loss for i in range(1, 7)]
    assert losses == sorted(losses, reverse=True)


def test_stops_early_where_the_loss_turns(spark, frame):
    """Labels without any pattern: more rounds only fit noise."""
    noise = frame.withColumn("label", (F.xxhash64("id") % 2 != 0).cast("double"))
    stopped = TR.fit_boosted(noise, FEATURES, max_iter=30, step=0.3, validation_share=0.3)
    full = TR.fit_boosted(noise, FEATURES, max_iter=30, step=0.3, validation_share=None)
    assert stopped.getNumTrees < 30 and full.getNumTrees == 30
