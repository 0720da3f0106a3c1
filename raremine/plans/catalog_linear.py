"""Catalog part 4: linear classifiers refitted on every split of the evaluator."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raremine.functions.numeric import round_doubles
from raremine.operators import features as FE
from raremine.operators import linear as LI
from raremine.operators import sampling as S
from raremine.plans import oracle as O
from raremine.plans.catalog_tabular import pdata
from raremine.plans.evaluate import eval_shuffle_cv_linear
from raremine.plans.standins import NUMERIC, PERSON_CLEAN_SQL, with_ctes

Q: dict = {}
SQL: dict = {}
STEP_FOLDS = 5


def scaled(spark, sf) -> DataFrame:
    return FE.scale_minmax(pdata(spark, sf), NUMERIC)


def q_eval_shuffle_cv_logistic(spark, sf):
    """The evaluator with logistic regression (C = 100, balanced classes): 1000
    stratified splits, a fit for each, pooled confusion counts and metrics."""
    return round_doubles(eval_shuffle_cv_linear(scaled(spark, sf), NUMERIC, 1000, "logistic", C=100.0, balanced=True), 6)


def q_eval_shuffle_cv_svc(spark, sf):
    """The evaluator with the squared-hinge linear SVC (C = 1, balanced classes)."""
    return round_doubles(eval_shuffle_cv_linear(scaled(spark, sf), NUMERIC, 1000, "squared_hinge", C=1.0, balanced=True), 6)


def step_weights(p: int, folds: int) -> np.ndarray:
    """A weight matrix for the twin: entry j of split f is (j + 1 - f) / 10."""
    return np.array([[(j + 1 - f) / 10 for j in range(p + 1)] for f in range(folds)])


def q_logistic_step(spark, sf):
    """One Newton step's sums (loss, gradient, Hessian) of all splits."""
    data = scaled(spark, sf)
    test = S.split_strat_shuffle(data, STEP_FOLDS)
    sums = LI.split_sums(LI.split_rows(data, NUMERIC, test), "logistic", range(STEP_FOLDS), step_weights(len(NUMERIC), STEP_FOLDS))
    return round_doubles(sums, 6)


def _logistic_step_sql() -> str:
    p = len(NUMERIC)
    x = [*NUMERIC, "1"]
    z = " + ".join(f"(CAST({j + 1} AS DOUBLE) - f.fold) / 10 * {c}" for j, c in enumerate(x))
    terms = ["ln(1 + exp(-y * z))"] + [f"-y * {c} / (1 + exp(y * z))" for c in x]
    terms += [f"{x[i]} * {x[j]} / (1 + exp(z)) / (1 + exp(-z))" for i in range(p + 1) for j in range(i, p + 1)]
    parts = " UNION ALL ".join(f"SELECT fold, {j} AS j, sum({t}) AS v FROM tr GROUP BY fold" for j, t in enumerate(terms))
    return with_ctes(PERSON_CLEAN_SQL, O.person_data_cte(name="plain"), O.minmax_cte("plain", NUMERIC, ("id", "label"), "data"),
                     *O.strat_split_ctes(STEP_FOLDS),
                     f"tr AS (SELECT f.fold, d.*, 2 * d.label - 1 AS y, {z} AS z FROM data d CROSS JOIN folds f WHERE NOT EXISTS"
                     " (SELECT 1 FROM test t WHERE t.fold = f.fold AND t.id = d.id))",
                     f"s AS ({parts})") + " SELECT CAST(fold AS INTEGER) AS fold, CAST(j AS INTEGER) AS j, round(v, 6) AS v FROM s"


Q.update(eval_shuffle_cv_logistic=q_eval_shuffle_cv_logistic, eval_shuffle_cv_svc=q_eval_shuffle_cv_svc, logistic_step=q_logistic_step)
SQL.update(logistic_step=_logistic_step_sql())
