"""Query catalog: one entry per operator key of the blueprint.

Each query takes ``(spark, sf_dir)``, reads the driver tables and returns a
DataFrame whose column names equal those of its SQL twin (DuckDB dialect).
Keys without a SQL twin (greedy walks, ML fits, UDF-based steps) are checked
on row counts by the driver and by the unit tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from raremine.functions.numeric import round_doubles
from raremine.plans import catalog_linear, catalog_models, catalog_tabular, catalog_text
from raremine.plans import oracle as O
from raremine.plans.evaluate import eval_shuffle_cv_gnb
from raremine.plans.standins import NUMERIC

EVAL_FOLDS = 1000


def q_eval_shuffle_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the reference evaluator with its default 1000 splits."""
    return round_doubles(eval_shuffle_cv_gnb(catalog_tabular.pdata(spark, sf_dir), NUMERIC, folds=EVAL_FOLDS))


QUERIES = {"eval_shuffle_cv": q_eval_shuffle_cv}
SQL = {"eval_shuffle_cv": O.sql_eval_shuffle_cv(EVAL_FOLDS)}

for _mod in (catalog_tabular, catalog_models, catalog_linear, catalog_text):
    QUERIES.update(_mod.Q)
    SQL.update(_mod.SQL)

SQL = {k: O.det_round_sql(v) for k, v in SQL.items()}
