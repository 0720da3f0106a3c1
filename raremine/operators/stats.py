"""Statistics over many columns: one aggregate pass for per-column facts,
long (unpivoted) form where a statistic is per (feature, group).

Results that pick columns come back to the driver as O(columns) values only.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


# functions of this module run in tasks of executors that lack the repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def to_long(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ("id",),
            name: str = "feature", value: str = "x") -> DataFrame:
    """Unpivot (an in-stage Expand, no shuffle)."""
    cast = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return cast.unpivot(list(ids), list(columns), name, value)


# ------------------------------------------------------------ column facts --

def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_null) for columns with any null; one aggregate."""
    cols = list(columns) if columns is not None else df.columns
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return agg.unpivot([], cols, "column", "n_null").filter(F.col("n_null") > 0)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, count) descending, nulls skipped (partial aggregation first)."""
    return (df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "value"))


def shape(df: DataFrame, target: str | None = None) -> DataFrame:
    """n_rows and n_features (columns minus target minus one, as the reference)."""
    n_feat = len(df.columns) - (1 if target in df.columns else 0) - 1
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_features", F.lit(n_feat))


def info(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null) — dtypes from the schema, counts in one pass."""
    agg = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    long = agg.unpivot([], df.columns, "column", "non_null")
    spark = df.sparkSession
    types = spark.createDataFrame([(c, t) for c, t in df.dtypes], "column string, dtype string")
    return long.join(F.broadcast(types), "column")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (linear), max per column.
    Moments in one aggregate; quartiles from the distributed exact quantiles."""
    aggs = []
    for j, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{j}"), F.avg(x).alias(f"m{j}"), F.stddev_samp(x).alias(f"s{j}"),
                 F.min(x).alias(f"lo{j}"), F.max(x).alias(f"hi{j}")]
    row = df.agg(*aggs).first()
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    rows = [(c, int(row[f"n{j}"]), row[f"m{j}"], row[f"s{j}"], row[f"lo{j}"], *q[c], row[f"hi{j}"])
            for j, c in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "feature string, count long, mean double, std double, "
                                                 "min double, q25 double, q50 double, q75 double, max double")


def quartiles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, q1, q3) with linear interpolation (distributed exact quantiles)."""
    q = exact_quantiles(df, columns, [0.25, 0.75])
    return df.sparkSession.createDataFrame([(c, *q[c]) for c in columns], "feature string, q1 double, q3 double")


def outlier_rows_iqr(df: DataFrame, columns: Sequence[str], how_far: float = 2.0,
                     worst_th: int = 6, key: str = "id") -> DataFrame:
    """Rows flagged outside [Q1 - s, Q3 + s] (s = how_far*IQR, missing counts as
    outside) in more than max(flags) - worst_th columns: ``(key, n_flags)``.

    The quartiles are one aggregate (2 numbers per column), applied as literals;
    the per-row flag count is a projection, the maximum one more aggregate."""
    q = quartiles(df, columns).collect()
    bounds = {r["feature"]: (r["q1"], r["q3"]) for r in q}
    flags = []
    for c in columns:
        q1, q3 = bounds[c]
        step = (q3 - q1) * how_far
        x = F.col(c).cast("double")
        inside = (x >= F.lit(q1 - step)) & (x <= F.lit(q3 + step))
        flags.append(F.when(F.coalesce(inside, F.lit(False)), 0).otherwise(1))
    scored = df.select(F.col(key), sum(flags).alias("n_flags")).filter(F.col("n_flags") >= 1)
    mx = scored.agg(F.max("n_flags")).first()[0]
    if mx is None:
        return scored.limit(0)
    return scored.filter(F.col("n_flags") > F.lit(mx - worst_th))


# ------------------------------------------------------------- correlation --

def value_cumcounts(long: DataFrame, group: str = "feature", value: str = "x") -> DataFrame:
    """Distinct (group, value) with ``_c`` = its count and ``_below`` = the
    number of rows of the group with a smaller value.

    Distinct values are range-partitioned on (group, value); running counts
    are taken inside each partition plus the per-group count of earlier
    partitions (a table of #partitions x #groups rows), so no task ever holds
    a whole column.  The frame is checkpointed so a lost executor cannot
    re-sample different range bounds between its uses."""
    from raremine.session import cut_lineage

    spark = long.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    d = long.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_c"))
    parted = d.repartitionByRange(n, group, value).withColumn("_pid", F.spark_partition_id())
    w = Window.partitionBy("_pid", group).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    local = cut_lineage(parted.withColumn("_cum", F.sum("_c").over(w)))
    tot = local.groupBy("_pid", group).agg(F.sum("_c").alias("_t"))
    wo = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.withColumn("_off", F.coalesce(F.sum("_t").over(wo), F.lit(0))).drop("_t")
    return (local.join(F.broadcast(off), ["_pid", group])
            .select(group, value, "_c", (F.col("_off") + F.col("_cum") - F.col("_c")).alias("_below")))


def average_ranks(long: DataFrame, group: str = "feature", value: str = "x",
                  out: str = "rank") -> DataFrame:
    """Average rank (ties share the mean rank) of ``value`` within ``group``,
    joined back on (group, value)."""
    from raremine.operators.joins import salted_join

    cc = value_cumcounts(long, group, value)
    ranks = cc.select(group, value, "_c", (F.col("_below") + (F.col("_c") + 1) / 2.0).alias(out))
    # a common value (e.g. zero) can hold a large share of a column
    return salted_join(long, ranks, [group, value], "left", count_col="_c")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict:
    """{column: [q(p) for p in probs]} with linear interpolation (numpy's
    default), computed without gathering a column in one task: the values at
    positions floor/ceil(p * (n - 1)) are looked up in the distributed
    cumulative counts (one small broadcast table of target positions)."""
    spark = df.sparkSession
    long = to_long(df, columns, ids=[])
    cc = value_cumcounts(long)
    counts = {r["feature"]: r["n"] for r in
              cc.groupBy("feature").agg(F.sum("_c").alias("n")).collect()}          # p rows
    targets, need = [], {}
    for c in columns:
        n = counts.get(c, 0)
        for p in probs:
            if n == 0:
                continue
            pos = p * (n - 1)
            lo, hi = math.floor(pos), math.ceil(pos)
            need[(c, p)] = (lo, hi, pos - lo)
            targets += [(c, lo), (c, hi)]
    if not targets:
        return {c: [None] * len(probs) for c in columns}
    tdf = spark.createDataFrame(sorted(set(targets)), "feature string, pos long")
    hit = (cc.join(F.broadcast(tdf), "feature")
           .filter((F.col("pos") >= F.col("_below")) & (F.col("pos") < F.col("_below") + F.col("_c")))
           .select("feature", "pos", "x").collect())                                  # <= 2 * p * |probs| rows
    at = {(r["feature"], r["pos"]): r["x"] for r in hit}
    out = {}
    for c in columns:
        vals = []
        for p in probs:
            if (c, p) not in need:
                vals.append(None)
                continue
            lo, hi, frac = need[(c, p)]
            a, b = at[(c, lo)], at[(c, hi)]
            vals.append(a + (b - a) * frac)
        out[c] = vals
    return out


#: Numbers of a chunk of rows, distinct values that are ranked together, and
#: sampled numbers that cut the columns into such bins.
CHUNK_NUMBERS, BIN_VALUES, SAMPLE_NUMBERS = 1_000_000, 250_000, 1_000_000


def _pack_rows(p: int):
    """Function over Arrow batches (x array, use) -> (chunk, n, x, present, use):
    blocks of rows as one matrix each."""
    size = max(1, CHUNK_NUMBERS // p, 4 * p)

    def run(batches):
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo in range(0, batch.num_rows, size):
                part = batch.slice(lo, size)
                flat = part.column(0).flatten()
                x = flat.fill_null(0.0).to_numpy(zero_copy_only=False).astype(np.float64)
                present = flat.is_valid().to_numpy(zero_copy_only=False)
                use = part.column(1).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int64()), "n": pa.array([part.num_rows], pa.int32()),
                                                  "x": [x.tobytes()], "present": [present.tobytes()], "use": [use.tobytes()]})
                chunk += 1
    return run


def _unpack(n: int, x: bytes, present: bytes, p: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(x).reshape(n, p), np.frombuffer(present, np.bool_).reshape(n, p)


def _sample_rows(p: int, step: int):
    """Function over chunks -> every ``step``-th of their rows, as (x, present)."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                x, present = _unpack(r["n"], r["x"], r["present"], p)
                yield pa.RecordBatch.from_pydict({"x": [x[::step].tobytes()], "present": [present[::step].tobytes()]})
    return run


def _distinct_values(p: int, cuts: list):
    """Function over chunks -> (chunk, col, bin, x, n): their distinct values by
    column and bin, with counts."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                x, present = _unpack(r["n"], r["x"], r["present"], p)
                out = {"chunk": [], "col": [], "bin": [], "x": [], "n": []}
                for j in range(p):
                    value, count = np.unique(x[present[:, j], j], return_counts=True)
                    edge = np.concatenate(([0], np.searchsorted(value, cuts[j], side="left"), [len(value)]))
                    for b in np.flatnonzero(np.diff(edge)).tolist():
                        at = slice(edge[b], edge[b + 1])
                        for name, v in zip(out, (r["chunk"], j, b, value[at].tobytes(), count[at].astype(np.int64).tobytes())):
                            out[name].append(v)
                yield pa.RecordBatch.from_arrays([pa.array(out["chunk"], pa.int64()), pa.array(out["col"], pa.int32()), pa.array(out["bin"], pa.int32()),
                                                  pa.array(out["x"], pa.binary()), pa.array(out["n"], pa.binary())], names=list(out))
    return run


def _rank_bin(table: pa.Table) -> pa.Table:
    """Average ranks of the values of one bin: (chunk, col, bin, r, total)."""
    xs = [np.frombuffer(v) for v in table["x"].to_pylist()]
    n = np.concatenate([np.frombuffer(v, np.int64) for v in table["n"].to_pylist()])
    _, place = np.unique(np.concatenate(xs), return_inverse=True)
    count = np.bincount(place, weights=n)                       # whole numbers below 2^53
    rank = (np.cumsum(count) - (count - 1) / 2)[place]
    ends = np.cumsum([len(x) for x in xs])
    return pa.table({"chunk": table["chunk"], "col": table["col"], "bin": table["bin"],
                     "r": pa.array([v.tobytes() for v in np.split(rank, ends[:-1])], pa.binary()),
                     "total": pa.array(np.full(len(xs), int(n.sum())), pa.int64())})


def _rank_products(p: int, before: list, middle: np.ndarray):
    """Function over (a chunk, its ranks) -> (i, lane, v): row i of the sums over
    the chunk's rows of r_i r_j, m_i m_j, r_i m_j and r_i^2 m_j, where r are the
    ranks less ``middle`` and m tells which values are present."""
    def run(rows: pa.Table, ranks: pa.Table) -> pa.Table:
        out = {"i": [], "lane": [], "v": []}
        pieces: dict = {}
        for j, b, r in zip(ranks["col"].to_pylist(), ranks["bin"].to_pylist(), ranks["r"].to_pylist()):
            pieces.setdefault(j, []).append((b, np.frombuffer(r) + before[j][b]))
        for c in rows.to_pylist():
            x, present = _unpack(c["n"], c["x"], c["present"], p)
            r = np.zeros(x.shape)
            for j, found in pieces.items():
                here = present[:, j]
                _, place = np.unique(x[here, j], return_inverse=True)
                r[here, j] = np.concatenate([v for _, v in sorted(found, key=lambda f: f[0])])[place] - middle[j]
            use = np.frombuffer(c["use"], np.bool_)
            r, m = r[use], present[use].astype(np.float64)
            v = np.hstack([r.T @ r, m.T @ m, r.T @ m, (r * r).T @ m])
            out["i"] += range(p)
            out["lane"] += [c["chunk"] % 64] * p
            out["v"] += [row.tobytes() for row in v]
        return pa.table({"i": pa.array(out["i"], pa.int32()), "lane": pa.array(out["lane"], pa.int64()), "v": pa.array(out["v"], pa.binary())})
    return run


def _sum_rows(table: pa.Table) -> pa.Table:
    total = 0.0
    for v in table["v"]:
        total = total + np.frombuffer(v.as_py())
    return pa.table({"i": table["i"][:1], "lane": table["lane"][:1], "v": pa.array([total.tobytes()], pa.binary())})


def spearman_matrix(df: DataFrame, columns: Sequence[str], key: str = "id") -> dict:
    """{(a, b): rho} for all ordered pairs (diagonal 1): Pearson's r of average
    ranks over the rows in which both columns are present (undefined: None).
    Ranks are taken over all rows; a key that repeats enters r once.

    Rows are written once, in blocks that are one matrix each.  A block sends
    the distinct values of each column with their counts, by bins of near values
    cut at sampled quantiles; a bin gives them ranks, which go back to the block
    that asked, and the block returns the p x p sums of its rank products.  So
    nothing is shuffled value by value, a common value is one entry of each
    block, and ranks do not depend on where the bins are cut."""
    from raremine.session import written

    cols = list(columns)
    p = len(cols)
    res = {(c, c): 1.0 for c in cols}
    if p < 2:
        return res
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in cols])
    rows = written(df.select(F.col(f"`{key}`").alias("key"), x.alias("x"), F.monotonically_increasing_id().alias("row")), "rank-rows")
    firsts = rows.groupBy("key").agg(F.min("row").alias("row")).select("row")
    n_rows = rows.count()
    if firsts.count() < n_rows:
        rows = rows.join(firsts.withColumn("use", F.lit(True)), "row", "left").withColumn("use", F.coalesce("use", F.lit(False)))
    else:
        rows = rows.withColumn("use", F.lit(True))
    chunks = written(rows.select("x", "use").mapInArrow(_pack_rows(p), "chunk long, n int, x binary, present binary, use binary"), "rank-chunks")

    n_bins = math.ceil(n_rows / BIN_VALUES)
    cuts = [np.zeros(0)] * p
    if n_bins > 1:
        step = math.ceil(n_rows * p / SAMPLE_NUMBERS)
        sample = chunks.select("n", "x", "present").mapInArrow(_sample_rows(p, step), "x binary, present binary").collect()   # about SAMPLE_NUMBERS numbers
        at = np.concatenate([np.frombuffer(r["x"]).reshape(-1, p) for r in sample])
        present = np.concatenate([np.frombuffer(r["present"], np.bool_).reshape(-1, p) for r in sample])
        for j in range(p):
            v = np.sort(at[present[:, j], j])
            v = v[:len(v) - int(np.isnan(v).sum())]                       # NaN ranks last, in the last bin
            if len(v):
                cuts[j] = np.unique(v[np.arange(1, n_bins) * len(v) // n_bins])
    values = chunks.select("chunk", "n", "x", "present").mapInArrow(_distinct_values(p, cuts), "chunk long, col int, bin int, x binary, n binary")
    ranks = written(values.groupBy("col", "bin").applyInArrow(_rank_bin, "chunk long, col int, bin int, r binary, total long"), "ranks")
    totals = np.zeros((p, max(n_bins, 1)))
    for r in ranks.groupBy("col", "bin").agg(F.first("total").alias("total")).collect():   # p x bins numbers
        totals[r["col"], r["bin"]] = r["total"]
    before = (np.cumsum(totals, axis=1) - totals).tolist()
    middle = (totals.sum(axis=1) + 1) / 2
    products = (chunks.groupBy("chunk").cogroup(ranks.drop("total").groupBy("chunk"))
                .applyInArrow(_rank_products(p, before, middle), "i int, lane long, v binary"))
    sums = products.groupBy("i", "lane").applyInArrow(_sum_rows, "i int, lane long, v binary")
    sums = sums.groupBy("i").applyInArrow(_sum_rows, "i int, lane long, v binary").collect()             # p rows of 4 p numbers
    whole = np.zeros((p, 4 * p))
    for r in sums:
        whole[r["i"]] = np.frombuffer(r["v"])
    xy, n, sx, sxx = np.hsplit(whole, 4)
    spread = n * sxx - sx * sx
    spread[spread <= 1e-13 * n * sxx] = 0.0                      # constant but for rounding
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i != j:
                d = math.sqrt(spread[i, j]) * math.sqrt(spread[j, i])
                res[(a, b)] = float((n[i, j] * xy[i, j] - sx[i, j] * sx[j, i]) / d) if d > 0 else None
    return res


#: Pair correlations per aggregate.
_PAIRS = 400


def _corr(a: str, b: str) -> Column:
    """Pearson r; null where a column is constant (``F.corr`` divides by zero there)."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(F.when(both, x)) * F.var_pop(F.when(both, y))))


def pearson_matrix(df: DataFrame, columns: Sequence[str]) -> dict:
    """{(a, b): r} over the rows in which both columns are present (NaN and
    undefined: None).  Columns without a null go through one distributed
    correlation matrix; pairs with a column that has some are aggregated pair
    by pair.  The rule is the same for any number of columns."""
    cols = list(columns)
    res = {(c, c): 1.0 for c in cols}
    if len(cols) < 2:
        return res
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)],
                   F.count(F.lit(1)).alias("n")).first()
    whole = [c for i, c in enumerate(cols) if nulls[f"n{i}"] == 0]
    if len(whole) > 40 and nulls["n"] > 1:
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.stat import Correlation

        vec = VectorAssembler(inputCols=whole, outputCol="_v", handleInvalid="keep").transform(df)
        m = Correlation.corr(vec, "_v", "pearson").first()[0].toArray()
        for i, a in enumerate(whole):
            for j, b in enumerate(whole):
                if i != j:
                    res[(a, b)] = None if math.isnan(m[i, j]) else float(m[i, j])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:] if (a, b) not in res]
    for lo in range(0, len(pairs), _PAIRS):
        part = pairs[lo:lo + _PAIRS]
        row = df.agg(*[_corr(a, b).alias(f"c{n}") for n, (a, b) in enumerate(part)]).first()
        for n, (a, b) in enumerate(part):
            v = row[f"c{n}"]
            res[(a, b)] = res[(b, a)] = None if v is None or math.isnan(v) else v
    return res


def matrix_frame(spark: SparkSession, mat: dict, columns: Sequence[str], value: str = "rho") -> DataFrame:
    rows = [(a, b, mat.get((a, b))) for a in columns for b in columns]
    return spark.createDataFrame(rows, T.StructType([
        T.StructField("f1", T.StringType()), T.StructField("f2", T.StringType()),
        T.StructField(value, T.DoubleType())]))


def drop_correlated(mat: dict, columns: Sequence[str], target: str | None,
                    threshold: float = 0.93) -> list[str]:
    """Greedy walk over the p x p matrix (driver, O(p^2)): for each kept column
    in order (target never drives), drop every other column with |rho| > t.
    The target itself is never dropped (deliberate fix)."""
    dropped: list[str] = []
    for c in columns:
        if c == target or c in dropped:
            continue
        for d in columns:
            if d == c or d in dropped or d == target:
                continue
            v = mat.get((c, d))
            if v is not None and abs(v) > threshold:
                dropped.append(d)
    return dropped


def vif(df: DataFrame, columns: Sequence[str]) -> dict:
    """VIF_j = [R^-1]_jj from the Pearson matrix; singular -> inf."""
    mat = pearson_matrix(df, columns)
    p = len(columns)
    r = np.array([[mat[(a, b)] if mat[(a, b)] is not None else 0.0 for b in columns] for a in columns])
    try:
        inv = np.linalg.inv(r)
        vals = np.diag(inv)
    except np.linalg.LinAlgError:
        vals = np.full(p, np.inf)
    return {c: float(vals[j]) for j, c in enumerate(columns)}


def vif_filter(df: DataFrame, columns: Sequence[str], thresh: float = 5.0) -> tuple[list[str], dict]:
    """Keep the columns whose VIF is at most ``thresh``; all others are
    dropped at once (one pass, not iterative).  Returns (kept, vif)."""
    v = vif(df, columns)
    return [c for c in columns if not (v[c] > thresh)], v


# ------------------------------------------------------------------ F-test --

def anova_f(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """One-way ANOVA F per feature: (feature, f).  Long form; the per
    (feature, class) moments are a partial aggregate (p*K rows)."""
    long = to_long(df, columns, ids=[label])
    return anova_f_long(long, label)


def anova_f_long(long: DataFrame, label: str = "label", feature: str = "feature",
                 value: str = "x") -> DataFrame:
    g = long.groupBy(feature, label).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v"))
    return anova_from_moments(g, feature)


def anova_from_moments(g: DataFrame, feature: str = "feature") -> DataFrame:
    """From (feature, class, n, m, v) rows: F = [SSB/(k-1)] / [SSW/(N-k)]."""
    tot = g.groupBy(feature).agg(
        F.sum("n").alias("_ntot"), F.count(F.lit(1)).alias("_k"),
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("_grand"),
        F.sum(F.col("n") * F.col("v")).alias("_ssw"))
    j = g.join(tot, feature)
    ssb = j.groupBy(feature, "_ntot", "_k", "_ssw").agg(
        F.sum(F.col("n") * (F.col("m") - F.col("_grand")) ** 2).alias("_ssb"))
    return ssb.select(feature, F.try_divide(
        F.try_divide(F.col("_ssb"), F.col("_k") - 1),
        F.try_divide(F.col("_ssw"), F.col("_ntot") - F.col("_k"))).alias("f"))


def select_k_best(scores: DataFrame, k: int, feature: str = "feature", score: str = "f") -> DataFrame:
    """The k features of largest score (null last, ties by name)."""
    return scores.orderBy(F.desc_nulls_last(score), feature).limit(k)


def select_percentile(scores: DataFrame, percentile: float = 10.0, feature: str = "feature",
                      score: str = "f") -> DataFrame:
    """Keep scores above the (100 - percentile)th percentile (linear); ties at
    the threshold are kept in feature order up to int(n * percentile / 100).

    The threshold is read off a distributed global rank (no single-task
    percentile buffer), so it scales with the number of features."""
    from raremine.operators.clean import global_row_number
    from raremine.session import cut_lineage

    # the score table has one row per feature: cut its lineage once so the
    # few small actions below do not recompute the statistics upstream
    # an undefined score counts as the lowest
    scored = cut_lineage(scores.select(feature, F.coalesce(score, F.lit(-sys.float_info.max)).alias(score)))
    n = scored.count()
    if n == 0:
        return scored
    pos = (n - 1) * (100.0 - percentile) / 100.0
    lo, hi = math.floor(pos), math.ceil(pos)
    ranked = global_row_number(scored.select(feature, score), [score, feature], "_r")
    vals = {r["_r"]: r[score] for r in ranked.filter(F.col("_r").isin(lo + 1, hi + 1)).collect()}
    thr = vals[lo + 1] + (vals[hi + 1] - vals[lo + 1]) * (pos - lo)
    max_feats = int(n * percentile / 100)
    above = scored.filter(F.col(score) > F.lit(thr))
    n_above = above.count()
    ties = scored.filter(F.col(score) == F.lit(thr)).orderBy(feature).limit(max(max_feats - n_above, 0))
    return above.unionByName(ties)
