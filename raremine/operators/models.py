"""Classifiers.

Gaussian naive Bayes (the reference's final model) is built from SQL
aggregates: its fitted state is K x p means/variances, so it is collected as
O(columns) numbers and applied as one generated column expression.  The fold
evaluator computes every fold's training statistics in ONE job:

    train stats of fold f = whole-table stats - stats of the test rows of f

so training sets are never expanded by fold, and a test row is one row with a
list of its folds.  Sums are taken after centring on the whole-table class mean
(numerically stable).

Other models wrap Spark ML estimators (``pyspark.ml.classification``).
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raremine import SEED
from raremine.operators.sampling import _per_class, split_rows, tested_folds

# functions of this module run in tasks of executors that lack the repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VAR_SMOOTHING = 1e-9
#: Fold models, one row each, that are sent to the tasks at once.
MAX_FOLD_MODELS = 20_000
#: Predictions of an Arrow batch.
_BATCH = 65_536


@dataclass
class GaussianNBModel:
    classes: list
    count: dict      # class -> n
    mean: dict       # class -> [mu_j]
    var: dict        # class -> [var_j] (smoothed)
    features: list

    def log_prior(self, c) -> float:
        return math.log(self.count[c] / sum(self.count.values()))


def _class_moments(df: DataFrame, features: Sequence[str], label: str):
    aggs = [F.count(F.lit(1)).alias("_n")]
    for j, f in enumerate(features):
        aggs += [F.avg(F.col(f).cast("double")).alias(f"_m{j}"),
                 F.var_pop(F.col(f).cast("double")).alias(f"_v{j}")]
    rows = df.groupBy(label).agg(*aggs).collect()      # K rows
    return {r[label]: r for r in rows}


def gnb_fit(df: DataFrame, features: Sequence[str], label: str = "label",
            var_smoothing: float = VAR_SMOOTHING) -> GaussianNBModel:
    """Fit on a DataFrame: one aggregate, K x p numbers come back."""
    mom = _class_moments(df, features, label)
    classes = sorted(mom)
    n = sum(mom[c]["_n"] for c in classes)
    # variance of every feature over all rows, from the class moments
    var_all = []
    for j in range(len(features)):
        mean = sum(mom[c]["_n"] * mom[c][f"_m{j}"] for c in classes) / n
        e2 = sum(mom[c]["_n"] * (mom[c][f"_v{j}"] + mom[c][f"_m{j}"] ** 2) for c in classes) / n
        var_all.append(max(e2 - mean * mean, 0.0))
    eps = var_smoothing * max(var_all) if var_all else 0.0
    return GaussianNBModel(
        classes=classes, count={c: mom[c]["_n"] for c in classes},
        mean={c: [mom[c][f"_m{j}"] for j in range(len(features))] for c in classes},
        var={c: [mom[c][f"_v{j}"] + eps for j in range(len(features))] for c in classes},
        features=list(features))


def _argmax(classes: Sequence, scores: Sequence[Column]) -> Column:
    """Class of largest score; ties -> smaller class; null score cannot win."""
    pred, best = F.lit(None), F.lit(None).cast("double")
    for c, s in zip(classes, scores):
        win = s.isNotNull() & (best.isNull() | (s > best))
        pred = F.when(win, F.lit(c)).otherwise(pred)
        best = F.when(win, s).otherwise(best)
    return pred


def gnb_predict(df: DataFrame, model: GaussianNBModel, out: str = "prediction") -> DataFrame:
    scores = []
    for c in model.classes:
        s = F.lit(model.log_prior(c) - 0.5 * sum(math.log(2 * math.pi * v) for v in model.var[c]))
        for f, mu, v in zip(model.features, model.mean[c], model.var[c]):
            d = F.col(f).cast("double") - F.lit(mu)
            s = s - d * d / F.lit(2 * v)
        scores.append(s)
    return df.withColumn(out, _argmax(model.classes, scores))


def _batch_rows(batch: pa.RecordBatch, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, which are present, class numbers) of a batch's rows."""
    flat = batch.column("x").flatten()
    x = flat.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, p)
    return x, flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, p), batch.column("_class").to_numpy()


def _fold_sums(p: int, folds: int, last: np.ndarray, means: np.ndarray):
    """Function over rows with ``near`` -> (fold, class number, n, sums, sums of
    squares) of its test rows, less the class means."""
    def run(batches):
        size = folds * len(means)
        n, total, squares = np.zeros(size, np.int64), np.zeros((p, size)), np.zeros((p, size))
        for batch in batches:
            x, present, cls = _batch_rows(batch, p)
            d = np.where(present, x - means[cls], 0.0)
            row, fold = tested_folds(batch.column("near"), cls, last)
            group = fold.astype(np.int64) * len(means) + cls[row]
            n += np.bincount(group, minlength=size)
            for j in range(p):
                v = d[row, j]
                total[j] += np.bincount(group, weights=v, minlength=size)
                squares[j] += np.bincount(group, weights=v * v, minlength=size)
        at = np.flatnonzero(n)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array((at // len(means)).astype(np.int32)), pa.array((at % len(means)).astype(np.int32)), pa.array(n[at]),
                                              *(pa.FixedSizeListArray.from_arrays(pa.array(v[:, at].T.ravel()), p).cast(pa.list_(pa.float64()))
                                                for v in (total, squares))], names=["fold", "_class", "n", "s", "q"])
    return run


def _fold_scores(p: int, first: int, last: np.ndarray, constant: np.ndarray, mean: np.ndarray, half: np.ndarray, key: str, label: str):
    """Function over rows with ``near`` -> (fold, key, label, class number) of
    the test rows of folds from ``first`` on that have a model here.  A class
    with an undefined number (masked) has no score, a row with a null none at all."""
    folds, k = constant.shape
    usable = ~(np.ma.getmaskarray(constant) | np.ma.getmaskarray(mean).any(axis=2) | np.ma.getmaskarray(half).any(axis=2))
    constant, mean, half = (np.ma.getdata(v) for v in (constant, mean, half))

    def run(batches):
        for batch in batches:
            x, present, cls = _batch_rows(batch, p)
            whole = present.all(axis=1)
            row, fold = tested_folds(batch.column("near"), cls, last)
            here = (fold >= first) & (fold < first + folds)
            row, fold = row[here], fold[here] - first
            for lo in range(0, len(row), _BATCH):
                r, f = row[lo:lo + _BATCH], fold[lo:lo + _BATCH]
                best, chosen = np.full(len(r), np.nan), np.full(len(r), -1, np.int32)
                for c in range(k):
                    s = constant[f, c]
                    for j in range(p):
                        d = x[r, j] - mean[f, c, j]
                        s = s - d * d * half[f, c, j]
                    # as Spark compares: NaN is above all
                    win = usable[f, c] & whole[r] & ((chosen < 0) | (s > best) | (np.isnan(s) & ~np.isnan(best)))
                    best, chosen = np.where(win, s, best), np.where(win, np.int32(c), chosen)
                at = pa.array(r)
                yield pa.RecordBatch.from_arrays([pa.array((f + first).astype(np.int32)), batch.column(key).take(at), batch.column(label).take(at),
                                                  pa.array(chosen)], names=["fold", "_key", "_label", "_best"])
    return run


def gnb_fold_predictions(data: DataFrame, features: Sequence[str], folds: int,
                         test_size: float = 0.1, seed: int = SEED, key: str = "id",
                         label: str = "label", var_smoothing: float = VAR_SMOOTHING) -> DataFrame:
    """Predictions of a Gaussian NB refitted on every stratified shuffle split:
    ``(fold, key, label, prediction)`` for the test rows of each fold.

    The narrow input (key, label, features) is checkpointed once: several
    small actions (class moments, split sizes) and the main job read it, and
    its upstream (e.g. an oversampling step) must not be recomputed each time.
    Each row is written once with the folds that test it; sums and scores of
    these folds are made where the row is."""
    from raremine.session import cut_lineage, written

    data = cut_lineage(data.select(key, label, *features))
    p = len(features)
    mom = _class_moments(data, features, label)
    classes = sorted(mom)
    wide = data.select(key, label, F.array(*[F.col(f).cast("double") for f in features]).alias("x"))
    types = data.schema
    out = T.StructType([T.StructField("fold", T.IntegerType()), T.StructField("_key", types[key].dataType),
                        T.StructField("_label", types[label].dataType), T.StructField("_best", T.IntegerType())])
    chosen = _per_class(F.col("_best"), dict(enumerate(classes)), None)
    found = split_rows(wide, folds, test_size, seed, key, label)
    if found is None:
        none = data.sparkSession.createDataFrame([], out)
        return none.select("fold", F.col("_key").alias(key), F.col("_label").alias(label), chosen.alias("prediction"))
    near, tested, last = found
    # classes too small for a test row have a model too, but no column in ``last``
    number = {c: i for i, c in enumerate(tested)}
    rows = near.withColumn("_class", _per_class(F.col(label), number, -1))

    # per fold and class: count, centred sum and sum of squares of the test rows
    means = np.array([[mom[c][f"_m{j}"] or 0.0 for j in range(p)] for c in tested]).reshape(len(tested), p)
    sums = rows.filter("_class >= 0").select("x", "near", "_class").mapInArrow(
        _fold_sums(p, folds, last, means), "fold int, _class int, n long, s array<double>, q array<double>")
    aggs = []
    for ci, c in enumerate(classes):
        is_c = F.col("_class") == F.lit(number.get(c, -1))
        aggs.append(F.coalesce(F.sum(F.when(is_c, F.col("n"))), F.lit(0)).alias(f"tn{ci}"))
        for j in range(p):
            aggs.append(F.sum(F.when(is_c, F.col("s")[j])).alias(f"ts{ci}_{j}"))
            aggs.append(F.sum(F.when(is_c, F.col("q")[j])).alias(f"tq{ci}_{j}"))
    per_fold = sums.groupBy("fold").agg(*aggs)

    # training statistics by subtraction
    cols = [F.col("fold")]
    for ci, c in enumerate(classes):
        n_all = mom[c]["_n"]
        ntr = F.lit(n_all) - F.col(f"tn{ci}")
        cols.append(ntr.cast("double").alias(f"n{ci}"))
        for j in range(p):
            s = -F.coalesce(F.col(f"ts{ci}_{j}"), F.lit(0.0))
            q = F.lit(n_all * mom[c][f"_v{j}"]) - F.coalesce(F.col(f"tq{ci}_{j}"), F.lit(0.0))
            shift = F.try_divide(s, ntr)
            cols.append((F.lit(mom[c][f"_m{j}"]) + shift).alias(f"mu{ci}_{j}"))
            cols.append(F.greatest(F.try_divide(q, ntr) - shift * shift, F.lit(0.0)).alias(f"var{ci}_{j}"))
    train = per_fold.select(*cols)

    n_tot = sum(F.col(f"n{ci}") for ci in range(len(classes)))
    var_all = []
    for j in range(p):
        mean = sum(F.coalesce(F.col(f"n{ci}") * F.col(f"mu{ci}_{j}"), F.lit(0.0))
                   for ci in range(len(classes))) / n_tot
        e2 = sum(F.coalesce(F.col(f"n{ci}") * (F.col(f"var{ci}_{j}") + F.col(f"mu{ci}_{j}") ** 2), F.lit(0.0))
                 for ci in range(len(classes))) / n_tot
        var_all.append(e2 - mean * mean)
    eps = F.lit(var_smoothing) * (F.greatest(*var_all) if p > 1 else var_all[0])
    train = train.withColumn("eps", eps)
    fold_cols = [F.col("fold")]
    for ci in range(len(classes)):
        const = F.log(F.try_divide(F.col(f"n{ci}"), n_tot))
        for j in range(p):
            vv = F.col(f"var{ci}_{j}") + F.col("eps")
            const = const - F.lit(0.5) * F.log(F.lit(2 * math.pi) * vv)
            fold_cols += [F.col(f"mu{ci}_{j}"), F.try_divide(F.lit(0.5), vv).alias(f"h{ci}_{j}")]
        fold_cols.append(F.when(F.col(f"n{ci}") > 0, const).alias(f"c{ci}"))
    fold_stats = written(train.select(*fold_cols), "fold-models")

    parts = []
    scored = rows.filter("_class >= 0").select(F.col(key).alias("_key"), F.col(label).alias("_label"), "x", "near", "_class")
    for first in range(0, folds, MAX_FOLD_MODELS):
        here = min(MAX_FOLD_MODELS, folds - first)
        constant, mean, half = (np.ma.masked_all(shape) for shape in ((here, len(classes)), (here, len(classes), p), (here, len(classes), p)))
        # folds x classes x features numbers
        for m in fold_stats.filter((F.col("fold") >= first) & (F.col("fold") < first + here)).collect():
            for ci in range(len(classes)):
                for table, at, name in [(constant, (m["fold"] - first, ci), f"c{ci}"),
                                        *((mean, (m["fold"] - first, ci, j), f"mu{ci}_{j}") for j in range(p)),
                                        *((half, (m["fold"] - first, ci, j), f"h{ci}_{j}") for j in range(p))]:
                    if m[name] is not None:
                        table[at] = m[name]
        parts.append(scored.mapInArrow(_fold_scores(p, first, last, constant, mean, half, "_key", "_label"), out))
    return reduce(DataFrame.union, parts).select("fold", F.col("_key").alias(key), F.col("_label").alias(label), chosen.alias("prediction"))


def gnb_group_fit(train_rows: DataFrame, group_cols: Sequence[str], features: Sequence[str],
                  classes: Sequence, label: str = "label",
                  var_smoothing: float = VAR_SMOOTHING) -> DataFrame:
    """Gaussian NB fitted separately for every group (e.g. (fold, size)) in one
    aggregate: per group one row with, for each class, the log prior and
    squared-distance weights.  Rows: one per group (small, broadcastable)."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for j, f in enumerate(features):
        aggs.append(F.var_pop(F.col(f).cast("double")).alias(f"_va{j}"))
    for ci, c in enumerate(classes):
        is_c = F.col(label) == F.lit(c)
        aggs.append(F.count_if(is_c).alias(f"n{ci}"))
        for j, f in enumerate(features):
            x = F.when(is_c, F.col(f).cast("double"))
            aggs += [F.avg(x).alias(f"mu{ci}_{j}"), F.var_pop(x).alias(f"var{ci}_{j}")]
    st = train_rows.groupBy(*group_cols).agg(*aggs)
    va = [F.col(f"_va{j}") for j in range(len(features))]
    st = st.withColumn("eps", F.lit(var_smoothing) * (F.greatest(*va) if len(va) > 1 else va[0]))
    cols = [F.col(g) for g in group_cols]
    for ci in range(len(classes)):
        const = F.log(F.col(f"n{ci}") / F.col("_n"))
        for j in range(len(features)):
            vv = F.col(f"var{ci}_{j}") + F.col("eps")
            const = const - F.lit(0.5) * F.log(F.lit(2 * math.pi) * vv)
            cols += [F.col(f"mu{ci}_{j}"), F.try_divide(F.lit(0.5), vv).alias(f"h{ci}_{j}")]
        cols.append(F.when(F.col(f"n{ci}") > 0, const).alias(f"c{ci}"))
    return st.select(*cols)


def gnb_group_predict(rows: DataFrame, stats: DataFrame, group_cols: Sequence[str],
                      features: Sequence[str], classes: Sequence, out: str = "prediction") -> DataFrame:
    """Score rows with the model of their group (stats broadcast: one row per group)."""
    scored = rows.join(F.broadcast(stats), list(group_cols))
    scores = []
    for ci in range(len(classes)):
        s = F.col(f"c{ci}")
        for j, f in enumerate(features):
            d = F.col(f).cast("double") - F.col(f"mu{ci}_{j}")
            s = s - d * d * F.col(f"h{ci}_{j}")
        scores.append(s)
    keep = [c for c in rows.columns]
    return scored.select(*keep, _argmax(classes, scores).alias(out))
