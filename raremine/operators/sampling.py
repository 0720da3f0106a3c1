"""Resampling: stratified shuffle splits, stratified k-fold, hold-out,
duplication oversampling and balanced class weights.

Every random choice is ``md5(seed|fold|key)``, so a split is a pure function of
the data and the seed, independent of partitioning and of executor count.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raremine import SEED
from raremine.functions.digest import first_digits, fold_digests, hex_digests
from raremine.functions.numeric import hash_key

# functions of this module run in tasks of executors that lack the repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Fold x class rows up to which the threshold table is broadcast.
MAX_BROADCAST_GROUPS = 200_000


def spread(df: DataFrame, key: str) -> DataFrame:
    """Before a row-multiplying explode: hash the input on the key over all
    cores (deterministic on recompute), so that the expanded rows of a small
    input are produced in parallel."""
    spark = df.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    return df.repartition(n, key)


def class_counts(df: DataFrame, label: str = "label") -> dict:
    """{class: count}; one small aggregate (size = number of classes)."""
    return {r[0]: int(r[1]) for r in df.groupBy(label).count().collect()}


def stratified_test_sizes(counts: dict, test_size: float | int) -> dict:
    """Test rows per class: total ceil(test_size*n) (or an int), shared by
    largest remainder; ties go to the smaller class label."""
    n = sum(counts.values())
    n_test = test_size if isinstance(test_size, int) else math.ceil(test_size * n)
    exact = {c: n_test * k / n for c, k in counts.items()}
    sizes = {c: math.floor(v) for c, v in exact.items()}
    left = n_test - sum(sizes.values())
    for c in sorted(counts, key=lambda c: (-(exact[c] - sizes[c]), c))[:left]:
        sizes[c] += 1
    return sizes


def _per_class(label: Column, values: dict, otherwise=0) -> Column:
    expr = None
    for c, v in sorted(values.items()):
        expr = (F.when(label == F.lit(c), F.lit(v)) if expr is None
                else expr.when(label == F.lit(c), F.lit(v)))
    return expr.otherwise(F.lit(otherwise))


#: Width, in standard deviations of a binomial count, of the band of digests
#: that surely (checked by counts) holds the wanted row of a group.
BAND_SIGMAS = 6.0
_DIGITS = 13


def _digest_prefix(share: float) -> str:
    """The first hex digits below which a ``share`` of all digests lies."""
    if share >= 1.0:
        return "g"                                    # above every digest
    return format(int(max(share, 0.0) * 16 ** _DIGITS), f"0{_DIGITS}x")


def digest_band(size: int, count: int) -> tuple[str, str]:
    """(low, high) digest prefixes between which the ``size``-th smallest of
    ``count`` random digests lies, but for about one case in 10^9.  The band
    holds some 12 * sqrt(size) rows, however many rows there are."""
    share = size / count
    margin = (BAND_SIGMAS * math.sqrt(max(size * (1 - share), 1.0)) + BAND_SIGMAS ** 2) / count
    return _digest_prefix(share - margin), _digest_prefix(share + margin)


def smallest_keys(df: DataFrame, groups: Sequence[str], size: Column, order: Sequence[str],
                  low: Column | None = None, n_groups: int = 1) -> DataFrame:
    """``(*groups, _last_0, _last_1, ...)``: per group the ``size``-th smallest
    value of ``order``, whose first column is a hex digest.

    Rows below ``low`` (a digest prefix, may use the group columns; default:
    none) and rows whose digest was left out (null) are only counted, by partial
    aggregation; the others are ranked.
    The counts, one row for each of ``n_groups`` groups, are broadcast if they
    are few; the ranked rows never are.  Groups of size zero, and groups whose row is not among the ranked ones,
    have no row."""
    below = F.coalesce(F.col(order[0]) < (low if low is not None else F.lit("")), F.lit(True))
    counts = df.groupBy(*groups).agg(F.count_if(below).alias("_below"))
    ranked = (df.filter(~below).select(*groups, *order)
              .withColumn("_rn", F.row_number().over(Window.partitionBy(*groups).orderBy(*order))))
    counts = counts.withColumn("_size", size)
    counts = F.broadcast(counts) if n_groups <= MAX_BROADCAST_GROUPS else counts.hint("merge")
    return (ranked.join(counts, list(groups))
            .filter(F.col("_rn") == F.col("_size") - F.col("_below"))
            .select(*groups, *[F.col(c).alias(f"_last_{i}") for i, c in enumerate(order)]))


def _up_to_last(order: Sequence[str]) -> Column:
    """``order`` is at most the threshold row of :func:`smallest_keys`; so is a
    row whose digest was left out as it lies below its band."""
    return F.col(order[0]).isNull() | (F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(order)])
            <= F.struct(*[F.col(f"_last_{i}").alias(f"c{i}") for i in range(len(order))]))


#: Rows whose digests a task looks at together.
_ROWS = 4096


def _as_number(prefix: str) -> int:
    """The number below which the first digits of digests below ``prefix`` lie."""
    return 16 ** _DIGITS if prefix == "g" else int(prefix.ljust(_DIGITS, "0"), 16)


def _near_folds(seed, folds: int, low: list, high: list):
    """Function over batches of rows (``_key`` text, ``_class`` number or -1) ->
    the other columns and ``near``: folds in which the row's digest lies below
    ``high`` of its class, with the digest unless it lies below ``low``."""
    low, high = (np.array([_as_number(v) for v in x] + [0], np.uint64) for x in (low, high))

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, _ROWS):
                part = batch.slice(lo, _ROWS)
                cls = part.column("_class").to_numpy()
                least, most = low[cls], high[cls]
                row, fold, band, texts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)], [np.zeros(0, "S32")]
                for f, r, words in fold_digests(seed, range(folds), part.column("_key").to_pylist()):
                    digits = first_digits(words, _DIGITS)
                    hit = np.flatnonzero(digits < most[r])
                    r, inside = r[hit], digits[hit] >= least[r[hit]]
                    row.append(r)
                    fold.append(f[hit])
                    band.append(inside)
                    texts.append(hex_digests(tuple(w[hit[inside]] for w in words)))
                row, fold, band = (np.concatenate(x) for x in (row, fold, band))
                digest = pa.array(np.concatenate(texts), pa.binary()).cast(pa.string()).take(pa.array(np.cumsum(band) - 1, mask=~band))
                order = np.argsort(row, kind="stable")
                near = pa.StructArray.from_arrays([pa.array(fold[order].astype(np.int32)), digest.take(pa.array(order))], names=["fold", "_h"])
                offs = np.searchsorted(row[order], np.arange(part.num_rows + 1)).astype(np.int32)
                names = [n for n in part.schema.names if n not in ("_key", "_class")]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.ListArray.from_arrays(pa.array(offs), near)],
                                                 names=[*names, "near"])
    return run


def _near_rows(df: DataFrame, folds: int, seed, key: str, bands: dict, label: str) -> DataFrame:
    """``df`` with ``near``, see :func:`_near_folds`; ``bands`` of (low, high) by class."""
    classes = sorted(bands)
    base = spread(df, key).select("*", F.col(key).cast("string").alias("_key"),
                                  _per_class(F.col(label), {c: i for i, c in enumerate(classes)}, -1).alias("_class"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema] +
                          [T.StructField("near", T.ArrayType(T.StructType([T.StructField("fold", T.IntegerType()), T.StructField("_h", T.StringType())])))])
    return base.mapInArrow(_near_folds(seed, folds, [bands[c][0] for c in classes], [bands[c][1] for c in classes]), schema)


def _split(df: DataFrame, folds: int, test_size: float | int, seed, key: str, label: str, form):
    """(``form`` of the rows with ``near``, written; thresholds), with the
    threshold of every (fold, class) checked to lie inside its band.  None
    without test rows."""
    from raremine.session import written

    counts = class_counts(df, label)
    sizes = {c: n for c, n in stratified_test_sizes(counts, test_size).items() if n > 0}
    if not sizes:
        return None
    for banded in (True, False):
        bands = {c: digest_band(n, counts[c]) if banded else ("", "g") for c, n in sizes.items()}
        near = written(form(_near_rows(df, folds, seed, key, bands, label)), "split")
        each = near if "_h" in near.columns else near.select(key, label, F.inline("near"))
        last = written(smallest_keys(each, ["fold", label], _per_class(F.col(label), sizes), ["_h", key],
                                     _per_class(F.col(label), {c: v[0] for c, v in bands.items()}, ""), folds * len(sizes)), "thresholds")
        if last.count() == folds * len(sizes):
            break
    return near, last, sorted(sizes)


def split_strat_shuffle(df: DataFrame, folds: int, test_size: float | int = 0.1,
                        seed: int = SEED, key: str = "id", label: str = "label",
                        keep: Sequence[str] = ()) -> DataFrame:
    """Test rows of ``folds`` independent stratified shuffle splits:
    ``(fold, key, label, *keep)``.  Each (fold, class) keeps its n_test(class)
    rows of smallest md5 key.

    Plan: every (fold, row) is hashed once, where the row is (``fold_digests``);
    those whose digest lies below or in the class's band (``digest_band``),
    little more than the test rows, are written to the shared scratch folder,
    with their digest only where it lies in the band: the copies of a row then
    lie side by side and pack to a few bytes each, a digest is 32.  Threshold
    rows come from that table, and the test rows are a filter of it against one
    row per (fold, class).  If a threshold lies outside its band, which the
    count of threshold rows tells, the split is done again without bands."""
    rows = df.select(key, label, *keep)
    found = _split(rows, folds, test_size, seed, key, label, lambda near: near.select(key, label, *keep, F.inline("near")))
    if found is None:
        return rows.select(F.lit(0).alias("fold"), "*").filter(F.lit(False))
    near, last, classes = found
    last = F.broadcast(last) if folds * len(classes) <= MAX_BROADCAST_GROUPS else last.hint("merge")
    return near.join(last, ["fold", label]).filter(_up_to_last(["_h", key])).select("fold", key, label, *keep)


def split_rows(df: DataFrame, folds: int, test_size: float | int, seed, key: str, label: str):
    """The splits of :func:`split_strat_shuffle` with every row kept once:
    (rows of ``df`` with ``near``, classes, last digest of each fold and class),
    for :func:`tested_folds`.  A row is not repeated for its test folds, and the
    digests that come back are one for every fold and class."""
    found = _split(df, folds, test_size, seed, key, label, lambda near: near)
    if found is None:
        return None
    near, last, classes = found
    at = {c: i for i, c in enumerate(classes)}
    digests = np.zeros((folds, len(classes)), "S32")
    for r in last.select("fold", label, "_last_0").collect():               # folds x classes rows
        digests[r["fold"], at[r[label]]] = r["_last_0"].encode()
    return near, classes, digests


def tested_folds(near: pa.ListArray, cls: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, fold) of the test rows in a batch; ``cls`` numbers the classes.
    Equal digests in a fold are equal keys, so digests alone decide."""
    row = np.repeat(np.arange(len(near)), near.value_lengths().to_numpy(zero_copy_only=False))
    fold, digest = near.flatten().flatten()
    fold = fold.to_numpy(zero_copy_only=False)
    band = np.flatnonzero(digest.is_valid().to_numpy(zero_copy_only=False))
    keep = np.ones(len(row), bool)
    keep[band] = digest.drop_null().to_numpy(zero_copy_only=False).astype("S32") <= last[fold[band], cls[row[band]]]
    return row[keep], fold[keep]


def split_strat_kfold(df: DataFrame, k: int, seed: int = SEED, key: str = "id",
                      label: str = "label") -> DataFrame:
    """Shuffled stratified k-fold: ``fold`` = (rank within class by md5) mod k.
    Adds column ``fold``; every row is tested exactly once.

    The rank comes from one distributed global row number over
    (label, md5, key) minus the row count of smaller classes, so no task has to
    hold a whole class."""
    from raremine.operators.clean import global_row_number

    counts = class_counts(df, label)
    offsets, run = {}, 0
    for c in sorted(counts):
        offsets[c] = run
        run += counts[c]
    ranked = global_row_number(df.withColumn("_h", hash_key(seed, F.col(key))), [label, "_h", key], "_rn")
    in_class = F.col("_rn") - _per_class(F.col(label), offsets)
    return ranked.withColumn("fold", F.pmod(in_class - 1, F.lit(k)).cast("int")).drop("_h", "_rn")


def split_holdout(df: DataFrame, test_size: float = 0.1, seed: int = SEED,
                  key: str = "id", exact: bool = True) -> DataFrame:
    """Adds ``is_test``.  exact: the ceil(test_size*n) rows of smallest md5 key,
    told by an exact threshold key (rows stay where they are; only the rows of
    a narrow digest band, see ``digest_band``, are ranked); otherwise a hash
    threshold (approximate size)."""
    h = hash_key(seed, F.col(key))
    if not exact:
        u = F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
        return df.withColumn("is_test", u < F.lit(test_size))
    n = df.count()
    n_test = math.ceil(test_size * n)
    if n_test == 0:
        return df.withColumn("is_test", F.lit(False))
    hashed = df.withColumn("_h", h)
    low, high = digest_band(n_test, n)
    near = hashed.select("_h", key).filter(F.col("_h") < F.lit(high)).withColumn("_all", F.lit(0))
    last = smallest_keys(near, ["_all"], F.lit(n_test), ["_h", key], F.lit(low)).first()
    if last is None:                                   # the row lies outside the band: rank all
        last = smallest_keys(hashed.withColumn("_all", F.lit(0)), ["_all"], F.lit(n_test), ["_h", key]).first()
    top, value = F.lit(last["_last_0"]), F.lit(last["_last_1"])
    return hashed.withColumn("is_test", (F.col("_h") < top) | ((F.col("_h") == top) & (F.col(key) <= value))).drop("_h")


def oversample_duplicate(df: DataFrame, passes: int = 1, label: str = "poi",
                         positive=1) -> DataFrame:
    """Each pass appends the current positive rows again (positives double per
    pass).  Written as one ``explode`` of 2**passes copies, no repeated unions."""
    copies = F.when(F.col(label) == F.lit(positive), F.lit(2 ** passes)).otherwise(F.lit(1))
    return (df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
            .drop("_copy"))


def class_weight_balanced(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """weight = n / (k * n_class).  Class counts are K numbers, applied as a
    literal per-class expression (no join, no shuffle)."""
    counts = class_counts(df, label)
    n, k = sum(counts.values()), len(counts)
    weights = {c: n / (k * m) for c, m in counts.items()}
    return df.withColumn(out, _per_class(F.col(label), weights).cast("double"))
