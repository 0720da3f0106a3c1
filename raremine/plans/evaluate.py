"""Evaluation workflows composed from the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from raremine import SEED
from raremine.operators.metrics import confusion_counts, confusion_metrics
from raremine.operators.models import gnb_fold_predictions


def eval_shuffle_cv_gnb(data: DataFrame, features: Sequence[str], folds: int = 1000,
                        test_size: float = 0.1, seed: int = SEED, key: str = "id",
                        label: str = "label") -> DataFrame:
    """The reference evaluator for Gaussian NB: ``folds`` stratified shuffle
    splits, fit/predict on each, pooled confusion counts and five metrics.
    GNB predictions are always a training class (0/1), so no fold is cut."""
    pred = gnb_fold_predictions(data, features, folds, test_size, seed, key, label)
    return confusion_metrics(confusion_counts(pred, label=label, fold=None))


def eval_shuffle_cv_linear(data: DataFrame, features: Sequence[str], folds: int = 1000, loss: str = "logistic",
                           C: float = 1.0, balanced: bool = False, test_size: float = 0.1, seed: int = SEED,
                           key: str = "id", label: str = "label") -> DataFrame:
    """The reference evaluator for logistic regression or the squared-hinge
    linear SVC: all splits are fitted together, one job per Newton step."""
    from raremine.operators.linear import linear_fold_predictions

    pred = linear_fold_predictions(data, features, folds, loss, C, balanced, test_size, seed, key, label)
    return confusion_metrics(confusion_counts(pred, label=label, fold=None))


def learning_curve_gnb(data: DataFrame, features: Sequence[str], k: int = 10, granularity: int = 10,
                       train_size: float = 0.9, test_size: float = 0.1, seed: int = SEED,
                       scale: bool = False, center: bool = False, key: str = "id",
                       label: str = "label", pca: int | float | bool | None = None) -> DataFrame:
    """Learning curve of Gaussian NB: ``(size, train_mean, train_std, val_mean,
    val_std)`` over k stratified shuffle splits.

    Sizes: trunc(linspace(20, n * train_size, granularity)).  For each split
    the training rows are taken in a seeded md5 order; the model for size s is
    fitted on the first s of them, scored (F1 of class 1) on those rows and on
    the split's test rows.  All (split, size) models are fitted in ONE
    aggregate; optional standard scaling (``scale``, ``center``) and then PCA
    (``pca``: True for all axes, a count or a variance share) are fitted on all
    training rows of the split, as in the reference.  Std is the population std
    over splits."""
    from pyspark.sql import functions as F

    from raremine.functions.numeric import hash_key
    from raremine.operators.clean import global_row_number
    from raremine.operators.features import pca_per_fold, scale_per_fold
    from raremine.operators.metrics import f1_prec_rec
    from raremine.operators.models import gnb_group_fit, gnb_group_predict
    from raremine.operators.sampling import class_counts, split_strat_shuffle, spread, stratified_test_sizes

    import numpy as np

    from raremine.session import cut_lineage, written

    data = cut_lineage(data.select(key, label, *features))
    counts = class_counts(data, label)
    classes = sorted(counts)
    n = sum(counts.values())
    sizes = [int(v) for v in np.linspace(20, n * train_size, granularity)]
    base = data.select(key, label, *features)
    test = split_strat_shuffle(base, k, test_size, seed, key, label, keep=features)
    allf = spread(base, key).withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    rows = allf.join(test.select("fold", key, F.lit(True).alias("is_test")), ["fold", key], "left") \
               .withColumn("is_test", F.coalesce("is_test", F.lit(False)))
    if scale or center:
        rows = scale_per_fold(rows, features, center=center, scale=scale)
    if pca:
        rows, features = pca_per_fold(written(rows, "curve-rows"), features, None if pca is True else pca)
    train = rows.filter(~F.col("is_test"))
    n_train = n - sum(stratified_test_sizes(counts, test_size).values())
    ranked = global_row_number(train.withColumn("_h", hash_key(seed, "train", F.col("fold"), F.col(key))),
                               ["fold", "_h", key], "_g")
    ranked = ranked.withColumn("_rn", F.col("_g") - F.col("fold") * F.lit(n_train))
    size_arr = F.array(*[F.lit(s) for s in sizes])
    sub = ranked.withColumn("size", F.explode(F.filter(size_arr, lambda s: s >= F.col("_rn"))))
    stats = gnb_group_fit(sub, ["fold", "size"], features, classes, label)
    p_train = gnb_group_predict(sub.select("fold", "size", key, label, *features), stats,
                                ["fold", "size"], features, classes)
    val = rows.filter("is_test").withColumn("size", F.explode(size_arr))
    p_val = gnb_group_predict(val.select("fold", "size", key, label, *features), stats,
                              ["fold", "size"], features, classes)
    f_tr = f1_prec_rec(p_train, label, group=["fold", "size"]).select("fold", "size", F.col("f1").alias("tr"))
    f_va = f1_prec_rec(p_val, label, group=["fold", "size"]).select("fold", "size", F.col("f1").alias("va"))
    both = f_tr.join(f_va, ["fold", "size"])
    return both.groupBy(F.col("size").cast("long").alias("size")).agg(F.avg("tr").alias("train_mean"), F.stddev_pop("tr").alias("train_std"),
                                    F.avg("va").alias("val_mean"), F.stddev_pop("va").alias("val_std"))


def eval_smote_train_gnb(data: DataFrame, features: Sequence[str], k: int = 5, seed: int = SEED,
                         key: str = "id", label: str = "label") -> DataFrame:
    """Gaussian NB under stratified k-fold with borderline SMOTE applied to
    each fold's TRAINING rows only (scope 'train': no synthetic row can reach
    a test fold).  All folds run in the same jobs: SMOTE searches every row's
    neighbours once for all folds, the NB fits are grouped by fold over rows
    replicated once per fold they train.  Pooled confusion counts and metrics
    over the k test folds."""
    from pyspark.sql import functions as F

    from raremine.operators.metrics import confusion_counts, confusion_metrics
    from raremine.operators.models import gnb_group_fit, gnb_group_predict
    from raremine.operators.neighbors import smote_borderline
    from raremine.operators.sampling import class_counts, split_strat_kfold, spread

    from raremine.session import cut_lineage

    data = cut_lineage(data.select(key, label, *features))
    classes = sorted(class_counts(data, label))
    folded = split_strat_kfold(data, k, seed, key, label)
    rows = (spread(folded, key).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
            .withColumn("is_test", F.col("fold") == F.col("g")))
    train = rows.filter(~F.col("is_test")).select("g", key, label, *features)
    syn = smote_borderline(folded, features, label, key, seed=seed, group="g", fold="fold", folds=k)
    fit_rows = train.select("g", F.col(key).cast("string").alias(key), label, *features) \
        .unionByName(syn.select("g", key, label, *features))
    stats = gnb_group_fit(fit_rows, ["g"], features, classes, label)
    test = rows.filter("is_test").select("g", key, label, *features)
    pred = gnb_group_predict(test, stats, ["g"], features, classes)
    return confusion_metrics(confusion_counts(pred, label=label, fold=None))
