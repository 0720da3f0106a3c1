"""Feature construction: scaling, pairwise interactions, column alignment.

Fitting a scaler is one aggregate over all columns (2 numbers per column come
back); applying it is a single ``select`` that stays in whole-stage codegen.
Interaction features are generated as ONE projection (never a withColumn loop).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raremine.session import written


def _stats(df: DataFrame, columns: Sequence[str], fns) -> dict:
    aggs = []
    for j, c in enumerate(columns):
        for name, fn in fns.items():
            aggs.append(fn(F.col(c).cast("double")).alias(f"{name}{j}"))
    row = df.agg(*aggs).first()
    return {c: {name: row[f"{name}{j}"] for name in fns} for j, c in enumerate(columns)}


def scale_minmax(df: DataFrame, columns: Sequence[str], lo: float = 0.0001, hi: float = 1.0) -> DataFrame:
    """Map each column linearly onto [lo, hi]; a constant column maps to lo."""
    st = _stats(df, columns, {"min": F.min, "max": F.max})
    cols = set(columns)
    out = []
    for c in df.columns:
        if c in cols:
            mn, mx = st[c]["min"], st[c]["max"]
            span = (mx - mn) if (mn is not None and mx is not None and mx != mn) else 1.0
            out.append((F.lit(lo) + (F.col(c).cast("double") - F.lit(mn)) / F.lit(span) * F.lit(hi - lo)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def scale_standard(df: DataFrame, columns: Sequence[str], center: bool = True,
                   scale: bool = True, fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std, std 0 -> 1; statistics from ``fit_on``
    (default: ``df`` itself)."""
    st = _stats(fit_on if fit_on is not None else df, columns,
                {"mean": F.avg, "std": F.stddev_pop})
    cols = set(columns)
    out = []
    for c in df.columns:
        if c in cols:
            e = F.col(c).cast("double")
            if center:
                e = e - F.lit(st[c]["mean"])
            if scale:
                sd = st[c]["std"] or 1.0
                e = e / F.lit(sd)
            out.append(e.alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def scale_per_fold(df: DataFrame, columns: Sequence[str], fold: str = "fold",
                   is_test: str = "is_test", center: bool = True, scale: bool = True) -> DataFrame:
    """Scaling fitted on the training rows of each fold and applied to all rows
    of that fold: a per-fold aggregate (one row per fold) joined back."""
    aggs = []
    for c in columns:
        x = F.when(~F.col(is_test), F.col(c).cast("double"))
        aggs += [F.avg(x).alias(f"_m_{c}"), F.stddev_pop(x).alias(f"_s_{c}")]
    st = df.groupBy(fold).agg(*aggs)
    joined = df.join(F.broadcast(st), fold)
    out = []
    for c in df.columns:
        if c in set(columns):
            e = F.col(c).cast("double")
            if center:
                e = e - F.col(f"_m_{c}")
            if scale:
                sd = F.col(f"_s_{c}")
                e = e / F.when(sd == 0, F.lit(1.0)).otherwise(sd)
            out.append(e.alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def pca_per_fold(df: DataFrame, columns: Sequence[str], n_components: int | float | None = None, fold: str = "fold",
                 is_test: str = "is_test", prefix: str = "pc") -> tuple[DataFrame, list[str]]:
    """PCA fitted on the training rows of each fold and applied to all rows of
    that fold: (frame with the scores as columns, their names).

    Sums and outer-product sums about the whole table's means are one grouped
    aggregate of (fold, entry); each fold's axes come from its p x p covariance
    where those sums end up.  ``n_components``: None = p, an int, or a variance
    share: the most axes that any fold needs for it (further scores of a fold
    are left in, so that all folds have the same columns).  Axes are signed by
    their largest loading.  The model is one row per fold."""
    p = len(columns)
    means = [m or 0.0 for m in df.agg(*[F.avg(F.col(c).cast("double")) for c in columns]).first()]
    x = F.array(*[F.col(c).cast("double") - F.lit(m) for c, m in zip(columns, means)])
    # the upper triangle of (1, x)(1, x)' row by row: counts, sums, products
    y = F.concat(F.array(F.lit(1.0)), x)
    places = [(i, j) for i in range(p + 1) for j in range(i, p + 1)]
    products = F.posexplode(F.flatten(F.transform(y, lambda a, i: F.transform(F.slice(y, i + 1, p + 1 - i), lambda b: a * b))))
    sums = (df.filter(~F.col(is_test)).select(fold, products.alias("_j", "_v"))
            .groupBy(fold, "_j").agg(F.sum("_v").alias("_v")))

    def axes(table: pd.DataFrame) -> pd.DataFrame:
        m = np.zeros((p + 1, p + 1))
        for j, v in zip(table["_j"], table["_v"]):
            a, b = places[j]
            m[a, b] = m[b, a] = v
        n = m[0, 0]
        mean = m[0, 1:] / n
        values, vectors = np.linalg.eigh(m[1:, 1:] / n - np.outer(mean, mean))
        values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(p)] < 0, -1.0, 1.0)
        total = values.sum() or 1.0
        return pd.DataFrame({fold: table[fold].iloc[:1].to_numpy(), "_mean": [(mean + means).tolist()],
                             "_axes": [vectors.T.tolist()], "_share": [np.cumsum(values / total).tolist()]})

    kind = dict(df.dtypes)[fold]
    model = sums.groupBy(fold).applyInPandas(axes, f"{fold} {kind}, _mean array<double>, _axes array<array<double>>, _share array<double>")
    model = written(model, "pca-folds")
    if n_components is None:
        k = p
    elif isinstance(n_components, float) and n_components < 1:
        reach = F.size(F.filter("_share", lambda v: v < F.lit(n_components - 1e-12))) + 1
        k = min(p, model.agg(F.max(reach)).first()[0] or p)
    else:
        k = min(p, int(n_components))
    names = [f"{prefix}{i + 1}" for i in range(k)]
    raw = F.array(*[F.col(c).cast("double") for c in columns])
    joined = df.join(F.broadcast(model), fold)                 # one row per fold
    centred = F.zip_with(raw, "_mean", lambda a, m: a - m)
    score = joined.withColumn("_x", centred)
    dot = [F.aggregate(F.zip_with("_x", F.get("_axes", F.lit(i)), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b).alias(n)
           for i, n in enumerate(names)]
    keep = [c for c in df.columns if c not in set(columns)]
    return score.select(*keep, *dot), names


def interaction_terms(columns: Sequence[str]) -> list[tuple[str, str, str]]:
    """(a, operator, b) of every interaction, pair by pair: product (squares
    kept) and sum once per pair, ratio and difference in both directions;
    3p^2 - 2p terms.  Their order matters to ``drop_correlated``."""
    terms = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            operators = "*" * (i <= j) + "+" * (i < j) + "/-" * (i != j)
            terms += [(a, op, b) for op in operators]
    return terms


def interaction_names(columns: Sequence[str]) -> list[str]:
    return ["".join(term) for term in interaction_terms(columns)]


def interaction_exprs(columns: Sequence[str]) -> list[Column]:
    """The interaction columns, named 'a*b', 'a+b', 'a/b', 'a-b'.  Ratios with
    a zero divisor are null (try_divide)."""
    make = {"*": lambda a, b: a * b, "+": lambda a, b: a + b, "/": F.try_divide, "-": lambda a, b: a - b}
    return [make[op](F.col(a), F.col(b)).alias(f"{a}{op}{b}") for a, op, b in interaction_terms(columns)]


def interaction_features(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ("id",)) -> DataFrame:
    """One projection with all pairwise features (plus ``keep`` columns)."""
    return df.select(*[F.col(k) for k in keep], *interaction_exprs(columns))


# ------------------------------------------------ features as one array column --

def interaction_array(df: DataFrame, vec: str, out: str = "interactions") -> DataFrame:
    """Adds the 3p^2 - 2p interactions of an array column as one array, in the
    order of :func:`interaction_names`.  The plan has the same size for any p:
    no term is a plan column.  Ratios with a zero divisor are null."""
    x = F.transform(F.col(vec), lambda v: v.cast("double"))
    number = F.sequence(F.lit(0), F.size(vec) - 1)

    def with_all(i):
        a = F.get("_x", i)

        def terms(j):
            b = F.get("_x", j)
            both = F.array(a * b, a + b, F.try_divide(a, b), a - b)
            return F.when(i < j, both).when(i == j, F.array(a * b)).otherwise(F.array(F.try_divide(a, b), a - b))
        return F.flatten(F.transform(number, terms))

    long = df.withColumn("_x", x)
    return long.withColumn(out, F.when(F.size(vec) > 0, F.flatten(F.transform(number, with_all))).otherwise(F.array().cast("array<double>"))).drop("_x")


def array_moments(df: DataFrame, vec: str) -> DataFrame:
    """(position, n, n_finite, min, max, mean, std) per entry of an array column:
    one aggregate by position; min to std over the finite entries."""
    e = df.select(F.posexplode(vec).alias("position", "v"))
    finite = F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < F.lit(float("inf")))
    x = F.when(finite, F.col("v"))
    return e.groupBy("position").agg(F.count(F.lit(1)).alias("n"), F.count(x).alias("n_finite"), F.min(x).alias("min"), F.max(x).alias("max"),
                                     F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"))


def finite_positions(df: DataFrame, vec: str) -> list[int]:
    """Positions whose entries are all finite (the array form of
    ``drop_nonfinite_columns``): p numbers on the driver."""
    m = array_moments(df, vec).filter("n = n_finite").select("position").orderBy("position")
    return [r["position"] for r in m.collect()]


def take_positions(df: DataFrame, vec: str, positions: Sequence[int]) -> DataFrame:
    """The array column with these positions only; positions are one literal."""
    chosen = F.lit(np.array(positions, dtype=np.int32)) if len(positions) else F.array().cast("array<int>")
    return df.withColumn(vec, F.transform(chosen, lambda i: F.get(F.col(vec), i)))


def scale_array(df: DataFrame, vec: str, lo: float = 0.0001, hi: float = 1.0) -> DataFrame:
    """Min-max scaling of every position of an array column; constant positions
    map to ``lo``.  The fitted ranges are two literal arrays."""
    m = array_moments(df, vec).orderBy("position").collect()
    least = [r["min"] if r["min"] is not None else 0.0 for r in m]
    span = [(r["max"] - r["min"]) if r["min"] is not None and r["max"] != r["min"] else 1.0 for r in m]
    fitted = F.arrays_zip(F.lit(np.array(least)).alias("a"), F.lit(np.array(span)).alias("s"))
    return df.withColumn(vec, F.zip_with(vec, fitted, lambda v, f: F.lit(lo) + (v - f["a"]) / f["s"] * F.lit(hi - lo)))


def add_missing_columns(df: DataFrame, source: DataFrame, columns: Sequence[str],
                        key: str = "id") -> DataFrame:
    """Add the ``columns`` of ``source`` not yet in ``df`` (left join on key)."""
    missing = [c for c in columns if c not in df.columns]
    if not missing:
        return df
    return df.join(source.select(key, *missing), key, "left")


def relative_importance(df: DataFrame, value: str, out: str = "relative") -> DataFrame:
    """100 * x / max(x) over a small per-feature table (one row per feature)."""
    mx = df.agg(F.max(value)).first()[0]
    return df.withColumn(out, F.try_divide(F.lit(100.0) * F.col(value), F.lit(mx)))
