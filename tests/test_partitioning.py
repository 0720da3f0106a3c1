"""SURVEY §5 (5): two partitionings give the same answer.  Every random
choice is md5 of explicit keys and every tie is broken by a key, so results
must not depend on the number of shuffle partitions or input splits."""

import pytest

from helpers import SMALL
from helpers import rows
from raremine.plans import catalog

KEYS = ["eval_shuffle_cv", "split_strat_kfold", "split_holdout", "encode_label", "corr_spearman",
        "outlier_rows_iqr", "join_knn", "smote_borderline", "tfidf", "learning_curve", "metric_roc_auc"]


@pytest.mark.parametrize("key", KEYS)
def test_same_answer_on_other_partitioning(spark, key):
    base = catalog.QUERIES[key](spark, SMALL).toPandas()
    old_sp = spark.conf.get("spark.sql.shuffle.partitions")
    old_mp = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")    # many small input splits
        other = catalog.QUERIES[key](spark, SMALL).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old_sp)
        spark.conf.set("spark.sql.files.maxPartitionBytes", old_mp)
    cols = sorted(base.columns)
    assert rows(base, cols) == rows(other, cols)
