"""Confusion counts and the metrics derived from them.

Everything is one aggregate over a prediction table ``(…, label, prediction)``;
undefined ratios are null (``try_divide``), never an exception.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                     fold: str | None = "fold", key: str = "id") -> DataFrame:
    """total, tp, fp, fn, tn pooled over all rows (and folds).

    As in the reference evaluator, a prediction outside {0, 1} stops the
    counting of its fold: rows of that fold at or after the first such
    prediction (in key order) are not counted."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    valid = p.isin(0.0, 1.0)
    rows = pred
    if fold is not None:
        bad = (pred.filter(~valid | p.isNull()).groupBy(fold)
               .agg(F.min(key).alias("_first_bad")))
        rows = (pred.join(bad, fold, "left")
                .filter(F.col("_first_bad").isNull() | (F.col(key) < F.col("_first_bad"))))
    rows = rows.filter(valid)
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if((p == 1) & (y == 1)).alias("tp"),
        F.count_if((p == 1) & (y == 0)).alias("fp"),
        F.count_if((p == 0) & (y == 1)).alias("fn"),
        F.count_if((p == 0) & (y == 0)).alias("tn"),
    )


def confusion_metrics(counts: DataFrame) -> DataFrame:
    """accuracy, precision, recall, f1 = 2TP/(2TP+FP+FN), f2 = 5PR/(4P+R)."""
    tp, fp, fn, tn, tot = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn", "total"))
    prec = F.try_divide(tp, tp + fp)
    rec = F.try_divide(tp, tp + fn)
    return counts.select(
        "*",
        F.try_divide(tp + tn, tot).alias("accuracy"),
        prec.alias("precision"),
        rec.alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.try_divide(5 * prec * rec, 4 * prec + rec).alias("f2"),
    )


def f1_prec_rec(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                group: Sequence[str] = ()) -> DataFrame:
    """Binary f1/precision/recall of class 1; 0 when undefined (library default)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    tp = F.count_if((p == 1) & (y == 1)).cast("double")
    fp = F.count_if((p == 1) & (y == 0)).cast("double")
    fn = F.count_if((p == 0) & (y == 1)).cast("double")
    agg = pred.groupBy(*group).agg(tp.alias("_tp"), fp.alias("_fp"), fn.alias("_fn"))
    t, f_p, f_n = F.col("_tp"), F.col("_fp"), F.col("_fn")
    return agg.select(
        *group,
        F.coalesce(F.try_divide(2 * t, 2 * t + f_p + f_n), F.lit(0.0)).alias("f1"),
        F.coalesce(F.try_divide(t, t + f_p), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(t, t + f_n), F.lit(0.0)).alias("recall"))


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """2x2 table: one row per true class, columns pred_0 / pred_1."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    return (pred.groupBy(y.alias("actual"))
            .agg(F.count_if(p == 0).alias("pred_0"), F.count_if(p == 1).alias("pred_1")))


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score",
            group: Sequence[str] = ()) -> DataFrame:
    """AUC by the rank-sum formula with average ranks for ties:
    (sum of positive ranks - P(P+1)/2) / (P N).

    Ranks come from distributed cumulative counts of the distinct scores per
    group (no window over all scores in one task)."""
    from raremine.operators.stats import value_cumcounts

    gkey = F.concat_ws("|", *[F.col(g).cast("string") for g in group]) if group else F.lit("all")
    y = F.col(label).cast("double")
    base = scored.select(*group, gkey.alias("_g"), F.col(score).cast("double").alias("_s"), y.alias("_y"))
    cc = value_cumcounts(base.select(F.col("_g").alias("feature"), F.col("_s").alias("x")))
    per = base.groupBy(*group, "_g", "_s").agg(F.sum("_y").alias("_pos"), F.count(F.lit(1)).alias("_n"))
    ranked = per.join(cc.select(F.col("feature").alias("_g"), F.col("x").alias("_s"),
                                (F.col("_below") + (F.col("_c") + 1) / 2.0).alias("_r")), ["_g", "_s"])
    agg = ranked.groupBy(*group).agg(
        F.sum(F.col("_r") * F.col("_pos")).alias("_rsum"),
        F.sum("_pos").alias("_P"), F.sum(F.col("_n") - F.col("_pos")).alias("_N"))
    return agg.select(*group, F.try_divide(
        F.col("_rsum") - F.col("_P") * (F.col("_P") + 1) / 2.0, F.col("_P") * F.col("_N")).alias("auc"))


def fold_summary(scores: DataFrame, group: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Mean and 3 x population std of per-fold scores."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), (3 * F.stddev_pop(m)).alias(f"{m}_3std")]
    return scores.groupBy(*group).agg(*aggs)


def threshold_label(score: Column, threshold: float = 0.5) -> Column:
    return F.when(score > F.lit(threshold), F.lit(1)).otherwise(F.lit(0))
