"""Linear classifiers fitted for many resampling splits at once.

The evaluator refits its classifier on every split (a thousand by default).
For logistic regression and the squared-hinge linear SVC one Newton step of
ALL splits is one Spark job: a task takes Arrow batches of rows, the weights of
all splits (a small matrix) and, per row, the splits that test it; it adds up
loss, gradient and Hessian of every split with matrix products and returns
them once per partition.  Spark sums them by (split, entry), each split's p x p
system is solved where its sums end up, and the driver only sees the weights:
splits x features numbers.  The driver loops over Newton steps, never over fits.

Objectives (no term grows with the number of splits):

* ``logistic``: |w|^2 / 2 + C * sum of s * log(1 + exp(-y z)); the intercept is
  not penalised.
* ``squared_hinge``: |w|^2 / 2 + C * sum of s * max(0, 1 - y z)^2; the intercept
  is one of the penalised weights.

y is -1 or 1, z = w.x + b, s the row's weight.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raremine import SEED
from raremine.operators.sampling import class_counts, split_strat_shuffle, stratified_test_sizes

# functions of this module run in tasks of executors that lack the repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOSSES = ("logistic", "squared_hinge")
#: Numbers that the sums of one task may take (8 bytes each), rows of a batch
#: that meet all splits at once, Newton steps and the step size that ends them.
TASK_NUMBERS, CHUNK_ROWS, MAX_STEPS, TOLERANCE = 16_000_000, 512, 60, 1e-9


def entry_count(p: int) -> int:
    """Loss, gradient and the upper triangle of the Hessian for p weights and an intercept."""
    m = p + 1
    return 1 + m + m * (m + 1) // 2


def _sums(loss: str, splits: np.ndarray, weights: np.ndarray):
    """Function over Arrow batches (y, s, x, tested) -> (fold, j, v): per split
    the sums over its training rows at its weights."""
    def run(batches):
        m = weights.shape[1]
        upper = np.triu_indices(m)
        total = np.zeros((len(splits), 1 + m + len(upper[0])))
        place = np.full(int(splits.max()) + 2, -1, np.int64)
        place[splits] = np.arange(len(splits))
        seen = False
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(lo, CHUNK_ROWS)
                n = part.num_rows
                seen = True
                y = part.column(0).to_numpy(zero_copy_only=False) * 2.0 - 1.0
                s = part.column(1).to_numpy(zero_copy_only=False)
                x = np.ones((n, m))
                x[:, :-1] = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, m - 1)
                tested = part.column(3)
                where = tested.flatten().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(n), tested.value_lengths().to_numpy(zero_copy_only=False))
                fold = place[np.minimum(where, len(place) - 1)]
                use = np.repeat(s[:, None], len(splits), axis=1)
                use[row[fold >= 0], fold[fold >= 0]] = 0.0                 # test rows take no part
                z = y[:, None] * (x @ weights.T)
                if loss == "logistic":
                    value = np.logaddexp(0.0, -z)
                    p = 0.5 * (1.0 - np.tanh(0.5 * z))                     # 1 / (1 + e^z), never overflows
                    slope, curve = -p, p * (1.0 - p)
                else:
                    gap = np.maximum(0.0, 1.0 - z)
                    value, slope, curve = gap * gap, -2.0 * gap, 2.0 * (gap > 0)
                total[:, 0] += (use * value).sum(axis=0)
                total[:, 1:1 + m] += (use * slope * y[:, None]).T @ x
                total[:, 1 + m:] += (use * curve).T @ (x[:, upper[0]] * x[:, upper[1]])
        if seen:
            k = total.shape[1]
            for i, f in enumerate(splits.tolist()):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(k, f, np.int32)), pa.array(np.arange(k, dtype=np.int32)), pa.array(total[i])],
                                                 names=["fold", "j", "v"])
    return run


def split_sums(rows: DataFrame, loss: str, splits: Sequence[int], weights: np.ndarray) -> DataFrame:
    """(fold, j, v): loss (j = 0), gradient and upper Hessian entries of the data
    term of every split.  ``rows``: (y 0/1, s, x array, tested array of folds)."""
    run = _sums(loss, np.asarray(splits, np.int64), np.asarray(weights, float))
    parts = rows.select(F.col("y").cast("double"), F.col("s").cast("double"), F.col("x").cast("array<double>"),
                        F.col("tested").cast("array<int>")).mapInArrow(run, "fold int, j int, v double")
    return parts.groupBy("fold", "j").agg(F.sum("v").alias("v"))


def _solve(c: float, penalty: np.ndarray, weights: dict):
    """Newton direction of one split from its sums."""
    m = len(penalty)
    upper = np.triu_indices(m)

    def run(key: tuple, table: pd.DataFrame) -> pd.DataFrame:
        v = np.zeros(1 + m + len(upper[0]))
        v[table["j"].to_numpy()] = table["v"].to_numpy()
        w = weights[int(key[0])]
        hessian = np.zeros((m, m))
        hessian[upper] = c * v[1 + m:]
        hessian = hessian + np.triu(hessian, 1).T + np.diag(penalty)
        gradient = c * v[1:1 + m] + penalty * w
        # entries of constant columns may leave the matrix singular: least squares then
        try:
            step = np.linalg.solve(hessian, gradient)
        except np.linalg.LinAlgError:
            step = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
        return pd.DataFrame({"fold": [int(key[0])], "loss": [c * v[0] + 0.5 * float((penalty * w * w).sum())],
                             "slope": [float(gradient @ step)], "step": [step.tolist()]})
    return run


def newton_splits(rows: DataFrame, folds: int, p: int, loss: str = "logistic", C: float = 1.0,
                  max_steps: int = MAX_STEPS, tolerance: float = TOLERANCE) -> np.ndarray:
    """Weights (folds x (p + 1), intercept last) of the model fitted on the
    training rows of each split.  Steps that do not lower a split's loss are
    halved; a split is done when its Newton decrement is below ``tolerance``.
    Splits whose sums do not fit a task together are dealt into blocks."""
    if loss not in LOSSES:
        raise ValueError(f"loss is one of {LOSSES}")
    m = p + 1
    penalty = np.ones(m)
    if loss == "logistic":
        penalty[-1] = 0.0
    block = max(1, min(folds, TASK_NUMBERS // max(entry_count(p), 3 * CHUNK_ROWS)))
    fitted = np.zeros((folds, m))
    for first in range(0, folds, block):
        open_ = np.arange(first, min(first + block, folds))
        at = {f: np.zeros(m) for f in open_.tolist()}           # weights whose loss is asked for
        base = {f: (np.zeros(m), np.inf, None, 1.0, 0.0) for f in at}   # weights, loss, step, share of it, slope
        for _ in range(max_steps):
            if not len(open_):
                break
            sums = split_sums(rows, loss, open_, np.stack([at[f] for f in open_.tolist()]))
            got = (sums.groupBy("fold").applyInPandas(_solve(C, penalty, {f: at[f] for f in open_.tolist()}),
                                                      "fold int, loss double, slope double, step array<double>").collect())
            left = []
            for r in got:                                       # one row per open split
                f, before = r["fold"], base[r["fold"]]
                # enough of the fall that the slope promises, but for rounding
                if r["loss"] > before[1] - 1e-4 * before[3] * before[4] + 1e-12 * abs(before[1]) and before[2] is not None and before[3] > 1e-6:
                    share = before[3] / 2
                    base[f] = (before[0], before[1], before[2], share, before[4])
                    at[f] = before[0] - share * before[2]
                    left.append(f)
                    continue
                step = np.array(r["step"])
                if r["slope"] <= tolerance * max(1.0, abs(r["loss"])) * 1e-3 or not np.isfinite(step).all():
                    fitted[f] = at[f]
                    continue
                base[f] = (at[f].copy(), r["loss"], step, 1.0, r["slope"])
                at[f] = at[f] - step
                left.append(f)
            open_ = np.array(sorted(left), np.int64)
        for f in open_.tolist():                                # steps ran out: the best weights seen
            fitted[f] = base[f][0]
    return fitted


def split_rows(data: DataFrame, features: Sequence[str], test: DataFrame, key: str = "id", label: str = "label",
               weights: dict | None = None) -> DataFrame:
    """(y, s, x, tested): one row per row of ``data`` with the splits that test
    it, written once: every Newton step reads it."""
    from raremine.session import written

    folds = test.groupBy(key).agg(F.collect_list("fold").alias("tested"))   # bounded by the number of splits
    s = F.lit(1.0)
    if weights:
        from raremine.operators.sampling import _per_class

        s = _per_class(F.col(label), weights, 1.0)
    x = F.array(*[F.col(f).cast("double") for f in features])
    joined = data.join(folds, key, "left")
    return written(joined.select(F.col(label).cast("double").alias("y"), s.cast("double").alias("s"), x.alias("x"),
                                 F.coalesce("tested", F.array().cast("array<int>")).cast("array<int>").alias("tested")), "split-rows")


def linear_fold_predictions(data: DataFrame, features: Sequence[str], folds: int, loss: str = "logistic", C: float = 1.0,
                            balanced: bool = False, test_size: float | int = 0.1, seed: int = SEED, key: str = "id",
                            label: str = "label") -> DataFrame:
    """``(fold, key, label, prediction)`` of the test rows of every stratified
    shuffle split, predicted by the model fitted on that split's other rows.
    Labels are 0 and 1; a score of 0 or less is class 0.  ``balanced`` weighs a
    row by n / (classes * rows of its class) of the split's training rows.
    Keys must be unique; features must be finite."""
    from raremine.session import cut_lineage

    data = cut_lineage(data.select(key, label, *features))
    counts = class_counts(data, label)
    sizes = stratified_test_sizes(counts, test_size)
    left = {c: counts[c] - sizes[c] for c in counts}            # the same in every split
    n = sum(left.values())
    weigh = {c: n / (len(left) * k) for c, k in left.items() if k} if balanced else None
    test = split_strat_shuffle(data, folds, test_size, seed, key, label, keep=features)
    w = newton_splits(split_rows(data, features, test, key, label, weigh), folds, len(features), loss, C)
    spark = data.sparkSession
    models = spark.createDataFrame([(f, v) for f, v in enumerate(w.tolist())], "fold int, _w array<double>")
    # splits x features numbers, collected above already
    scored = test.join(F.broadcast(models), "fold")
    x = F.array(*[F.col(f).cast("double") for f in features], F.lit(1.0))
    z = F.aggregate(F.zip_with(x, "_w", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    return scored.select("fold", key, label, F.when(z > 0, 1.0).otherwise(0.0).alias("prediction"))


# ------------------------------------------- hinge loss, as Spark ML fits it --

#: Rows of a packed record, bytes of features of a written partition, partitions
#: whose sums the driver adds up itself, step lengths looked at in one job.
PACK_ROWS, PACK_BYTES, DRIVER_PARTS, AHEAD = 2048, 4 << 20, 64, 4


def _pack(p: int, folds: int):
    """Function over Arrow batches (y, x, tested) -> records of up to
    ``PACK_ROWS`` rows: (n, y, x, mask), the mask a bit for every row and fold it trains."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, PACK_ROWS):
                part = batch.slice(lo, PACK_ROWS)
                n = part.num_rows
                y = part.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                tested = part.column(2)
                use = np.ones((n, folds), bool)
                use[np.repeat(np.arange(n), tested.value_lengths().to_numpy(zero_copy_only=False)),
                    tested.flatten().to_numpy(zero_copy_only=False)] = False
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in (y, x.reshape(n, p), np.packbits(use)))],
                                                 names=["n", "y", "x", "mask"])
    return run


def _over_records(p: int, folds: int, size: int, add):
    """Function over packed records -> one row (v) per partition: ``size`` numbers,
    to which ``add(total, y, x, use)`` adds a record's."""
    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            for n, y, x, mask in zip(*(batch.column(i).to_pylist() for i in range(4))):
                add(total, np.frombuffer(y), np.frombuffer(x).reshape(n, p),
                    np.unpackbits(np.frombuffer(mask, np.uint8), count=n * folds).reshape(n, folds).astype(bool))
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), pa.array(total))], names=["v"])
    return run


def _summed(packed: DataFrame, parts: int, p: int, folds: int, size: int, add) -> np.ndarray:
    out = packed.mapInArrow(_over_records(p, folds, size, add), "v array<double>")
    if parts <= DRIVER_PARTS:
        return np.sum([r["v"] for r in out.collect()], axis=0)
    total = np.zeros(size)
    for r in out.select(F.posexplode("v").alias("j", "x")).groupBy("j").agg(F.sum("x").alias("x")).collect():
        total[r["j"]] = r["x"]
    return total


class _Stuck(Exception):
    pass


def _direction(steps: list, changes: list, g: np.ndarray) -> np.ndarray:
    """L-BFGS direction from the last steps and gradient changes, newest first."""
    d = g.copy()
    scale = 1.0
    if steps:
        sy, yy = steps[0] @ changes[0], changes[0] @ changes[0]
        if sy < 0 or np.isnan(sy):
            raise _Stuck
        scale = sy / yy
    rho, share = [], []
    for s, c in zip(steps, changes):
        rho.append(s @ c)
        share.append((s @ d) / rho[-1])
        if np.isnan(share[-1]):
            raise _Stuck
        d -= share[-1] * c
    d *= scale
    for i in range(len(steps) - 1, -1, -1):
        d += (share[i] - (changes[i] @ d) / rho[i]) * steps[i]
    return -d


def _quasi_newton(m: int, max_iter: int, tol: float, memory: int = 10, values: int = 20):
    """The optimiser behind Spark ML's LinearSVC (OWL-QN without a first-order
    penalty, backtracking search): a generator that yields points whose
    (value, gradient) it is sent, and returns (weights, values)."""
    x = np.zeros(m)
    (f, g), = yield [x]
    first, seen, path, done, failed = f, [np.inf], [f], 0, False
    steps, changes = [], []
    while True:
        if done >= max_iter or (len(seen) >= 2 and abs(f - max(seen)) <= tol * first) or np.sqrt(g @ g) <= max(tol * f, 1e-8):
            return x, path
        try:
            with np.errstate(all="ignore"):
                d = _direction(steps, changes, g)
            d = np.where(d * g < 0, d, 0.0)
            side = np.where(x != 0, np.sign(x), np.sign(-g))
            known = {}

            def at(alpha):
                v = x + d * alpha
                return np.where(np.sign(v) == side, v, 0.0)

            shrink, alpha = (0.1, 0.5 / np.sqrt(g @ g)) if done < 1 else (0.5, 1.0)
            # its search holds the first length against the value it starts from, so shortens it once
            slope, tries, value, grad = d @ g, 0, f, g
            while slope != 0:
                if tries:
                    if alpha not in known:
                        ask = [alpha * shrink ** i for i in range(AHEAD - 1)] + [alpha * 2.1]
                        got = yield [at(a) for a in ask]
                        known.update({a: (v, h) for a, (v, h) in zip(ask, got)})
                    value, grad = known[alpha]
                rise = d @ grad
                if value > f + alpha * slope * 1e-4:
                    times = shrink
                elif rise < 0.9 * slope:
                    times = 2.1
                elif abs(rise) > 0.9 * abs(slope):
                    times = shrink
                else:
                    break
                alpha, tries = alpha * times, tries + 1
                if tries > 20 or not 1e-10 <= alpha <= 1e10:
                    raise _Stuck
            new = at(alpha)
            steps, changes = [new - x, *steps][:memory], [grad - g, *changes][:memory]
            x, f, g, done, failed = new, value, grad, done + 1, False
            seen = [*seen, f][-values:]
            path.append(f)
        except _Stuck:
            if failed:
                return x, path
            failed, steps, changes = True, [], []
            path.append(f)


def hinge_splits(rows: DataFrame, folds: int, p: int, C: float | None = None, regParam: float = 0.0, max_iter: int = 100,
                 tol: float = 1e-6) -> tuple[np.ndarray, list]:
    """Weights (folds x (p + 1), intercept last) of Spark ML's LinearSVC fitted
    on the training rows of each split, and the values each fit went through.
    Same objective (mean hinge loss, features divided by their deviation among the
    training rows, less their mean; ``regParam`` = 1 / (C * n) on their weights) and same
    steps, but for rounding; one job looks at the next points of all splits.  ``rows``: (y 0/1, x array,
    tested array of folds)."""
    from raremine.session import written

    # some MB a partition, so that a look at the points is few tasks
    n_rows = rows.count()
    parts = max(1, -(-n_rows * p * 8 // PACK_BYTES))
    packed = written(rows.select(F.col("y").cast("double"), F.col("x").cast("array<double>"), F.col("tested").cast("array<int>")).repartition(parts)
                     .mapInArrow(_pack(p, folds), "n int, y binary, x binary, mask binary"), "svc-rows")
    parts = packed.rdd.getNumPartitions()

    def means(total, y, x, use):
        total[:p] += x.sum(axis=0)
    centre = _summed(packed, parts, p, folds, p, means) / max(n_rows, 1)

    def moments(total, y, x, use):
        t, u, d = total.reshape(folds, 2 * p + 1), use.astype(np.float64).T, x - centre
        t[:, 0] += u.sum(axis=1)
        t[:, 1:1 + p] += u @ d
        t[:, 1 + p:] += u @ (d * d)
    mom = _summed(packed, parts, p, folds, folds * (2 * p + 1), moments).reshape(folds, 2 * p + 1)
    n = np.maximum(mom[:, 0], 1.0)
    var = (mom[:, 1 + p:] - mom[:, 1:1 + p] ** 2 / n[:, None]) / np.maximum(n - 1, 1)[:, None]
    # a column of one value among the training rows, but for rounding
    flat = var <= np.maximum(1e-12 * mom[:, 1 + p:] / n[:, None], 1e-26 * centre ** 2)
    inverse = np.where(flat, 0.0, 1.0 / np.sqrt(np.where(flat, 1.0, var)))
    mean = centre + mom[:, 1:1 + p] / n[:, None]
    reg = 1.0 / (C * n) if C is not None else np.full(folds, regParam)

    def look(points: list) -> list:
        """(value, gradient) at (fold, weights) points."""
        fold = np.array([f for f, _ in points])
        w = np.stack([v for _, v in points])
        raw = w[:, :p] * inverse[fold]
        raw = np.column_stack([raw, w[:, p] - (raw * mean[fold]).sum(axis=1)])

        def add(total, y, x, use):
            t = total.reshape(len(fold), p + 2)
            sign = (2.0 * y - 1.0)[:, None]
            gap = 1.0 - sign * (x @ raw[:, :p].T + raw[:, p])
            hit = use[:, fold] & (gap > 0)
            t[:, 0] += np.where(hit, gap, 0.0).sum(axis=0)
            pull = -(hit * sign)
            t[:, 1:1 + p] += pull.T @ x
            t[:, 1 + p] += pull.sum(axis=0)
        got = _summed(packed, parts, p, folds, len(fold) * (p + 2), add).reshape(len(fold), p + 2) / n[fold][:, None]
        out = []
        for (f, v), r in zip(points, got):
            grad = np.append((r[1:1 + p] - r[1 + p] * mean[f]) * inverse[f] + reg[f] * v[:p], r[1 + p])
            out.append((r[0] + 0.5 * reg[f] * float(v[:p] @ v[:p]), grad))
        return out

    runs = {f: _quasi_newton(p + 1, max_iter, tol) for f in range(folds)}
    asked = {f: next(run) for f, run in runs.items()}
    fitted, paths = np.zeros((folds, p + 1)), [None] * folds
    while asked:
        points = [(f, v) for f, vs in asked.items() for v in vs]
        got = iter(look(points))
        answers = {f: [next(got) for _ in vs] for f, vs in asked.items()}
        asked = {}
        for f, a in answers.items():
            try:
                asked[f] = runs[f].send(a)
            except StopIteration as end:
                w, paths[f] = end.value
                raw = w[:p] * inverse[f]
                fitted[f] = np.append(raw, w[p] - raw @ mean[f])
    return fitted, paths


def score_splits(rows: DataFrame, weights: np.ndarray, key: str = "id", label: str = "label") -> DataFrame:
    """``(fold, key, label, prediction)`` for every fold in a row's ``folds``
    (array); a score of 0 or less is class 0.  ``rows`` has ``x`` (array)."""
    p = weights.shape[1] - 1
    types = dict(rows.dtypes)

    def run(batches):
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, p)
            listed = batch.column(3)
            row = np.repeat(np.arange(batch.num_rows), listed.value_lengths().to_numpy(zero_copy_only=False))
            fold = listed.flatten().to_numpy(zero_copy_only=False)
            z = (x @ weights[:, :p].T + weights[:, p])[row, fold]
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(fold.astype(np.int32)), batch.column(0).take(at), batch.column(1).take(at),
                                              pa.array((z > 0).astype(np.float64))], names=["fold", key, label, "prediction"])

    return rows.select(key, label, F.col("x").cast("array<double>"), F.col("folds").cast("array<int>")).mapInArrow(
        run, f"fold int, {key} {types[key]}, {label} {types[label]}, prediction double")
