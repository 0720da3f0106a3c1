"""Cleaning, imputation, encoding and the feature-format family.

All operators are column expressions in one ``select``; statistics that pick
columns are a single ``agg`` over all columns (one job, not one per column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENTINEL = "NaN"


def _numeric(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


# ------------------------------------------------------------------ cleaning --

def clean_records(df: DataFrame, target: str, skip: Sequence[str] = ("email_address",),
                  key: str = "id") -> DataFrame:
    """Sentinel 'NaN' -> null; target truthy -> 1 else 0; skip columns stay text;
    every other column becomes DOUBLE (unparsable text -> null)."""
    out = []
    for c in df.columns:
        if c == key:
            out.append(F.col(c))
        elif c == target:
            out.append(clean_bool_target(F.col(c)).alias(c))
        elif c in skip:
            out.append(F.nullif(F.col(c), F.lit(SENTINEL)).alias(c))
        else:
            out.append(clean_sentinel_numeric(F.col(c)).alias(c))
    return df.select(*out)


def clean_sentinel_numeric(c: Column) -> Column:
    # nullif first: a plain cast of 'NaN' gives a real NaN, not a missing value
    return F.nullif(c.cast("string"), F.lit(SENTINEL)).try_cast("double")


def clean_bool_target(c: Column) -> Column:
    return F.when(c.cast("string").try_cast("boolean"), F.lit(1)).otherwise(F.lit(0))


def drop_row_by_key(df: DataFrame, value: str = "TOTAL", key: str = "id") -> DataFrame:
    return df.filter(F.col(key) != F.lit(value))


def impute_constant(df: DataFrame, value, subset: Sequence[str] | None = None) -> DataFrame:
    """Fill nulls with a constant (numeric columns; text columns get its string)."""
    cols = set(subset) if subset is not None else set(df.columns)
    out = []
    for f in df.schema.fields:
        if f.name in cols and isinstance(f.dataType, T.NumericType):
            out.append(F.coalesce(F.col(f.name), F.lit(value).cast(f.dataType)).alias(f.name))
        elif f.name in cols and isinstance(f.dataType, T.StringType):
            out.append(F.coalesce(F.col(f.name), F.lit(str(value))).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def check_sentinel_free(df: DataFrame, value: float, columns: Sequence[str]) -> DataFrame:
    """(column, present): is ``value`` already used in each column?  One pass."""
    agg = df.agg(*[F.coalesce(F.bool_or(F.col(c) == F.lit(value)), F.lit(False)).alias(c)
                   for c in columns])
    return agg.unpivot([], list(columns), "column", "present")


def encode_label(df: DataFrame, column: str, out: str, missing: str = "-1") -> DataFrame:
    """Dense code of the text value in byte order (missing -> ``missing`` first).

    The distinct values are ranked with a distributed sort (``global_row_number``)
    and joined back on the value, so no single task sees all values."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(missing))
    base = df.withColumn("_code_value", text)
    distinct = base.groupBy("_code_value").agg(F.count(F.lit(1)).alias("_vn"))
    ranked = global_row_number(distinct, ["_code_value"], "_code")
    codes = ranked.select("_code_value", "_vn", (F.col("_code") - 1).cast("int").alias(out))
    # the missing marker (or any common value) may hold a large share of rows
    from raremine.operators.joins import salted_join

    return salted_join(base, codes, ["_code_value"], "left", count_col="_vn").drop("_code_value")


def global_row_number(df: DataFrame, order_cols: Sequence[str], out: str = "rn",
                      partitions: int | None = None) -> DataFrame:
    """1-based row number over a global order without a single-partition window.

    Range-partition on the order and sort inside each partition (one shuffle);
    ``monotonically_increasing_id`` then encodes (partition, position) of each
    row, and the running count of earlier partitions (a table of #partitions
    rows) turns positions into global numbers.  The numbered frame is
    checkpointed so that a lost executor cannot re-sample different range
    bounds between its two uses.  ``order_cols`` must make the order total."""
    from raremine.session import cut_lineage

    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    mid = F.monotonically_increasing_id()
    local = cut_lineage(df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
                        .withColumn("_mid", mid)
                        .withColumn("_pid", F.shiftright(F.col("_mid"), 33))
                        .withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid"), 33) + 1))
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    return (local.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
            .withColumn(out, (F.col("_off") + F.col("_local")).cast("long"))
            .drop("_pid", "_off", "_local", "_mid"))


# --------------------------------------------------------- feature formatting --

def feature_format(df: DataFrame, features: Sequence[str], key: str = "id",
                   remove_nan: bool = True, remove_all_zeroes: bool = True,
                   remove_any_zeroes: bool = False, sort_keys=False,
                   key_order: DataFrame | None = None) -> DataFrame:
    """Ordered numeric matrix from a keyed frame.

    ``features[0]`` is exempt from the zero tests only when it is named 'poi'
    (as in the reference).  Missing -> 0.0 when ``remove_nan``; otherwise null
    stays and counts as non-zero.  ``sort_keys``: False keeps input order, True
    sorts by key, 'preset' orders by ``key_order(id, ord)`` (inner join)."""
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise ValueError(f"features not present: {missing}")
    vals = []
    for f in features:
        c = F.col(f).cast("double")
        vals.append((F.coalesce(c, F.lit(0.0)) if remove_nan else c).alias(f))
    out = df.select(F.col(key), *vals)
    tested = list(features[1:]) if features[0] == "poi" else list(features)
    if remove_all_zeroes and tested:
        keep = F.lit(False)
        for f in tested:
            keep = keep | F.coalesce(F.col(f) != 0, F.lit(True))
        out = out.filter(keep)
    if remove_any_zeroes and tested:
        drop = F.lit(False)
        for f in tested:
            drop = drop | F.coalesce(F.col(f) == 0, F.lit(True))
        out = out.filter(~drop)
    if sort_keys == "preset":
        if key_order is None:
            raise ValueError("preset key order needs key_order(id, ord)")
        out = out.join(key_order, key, "inner").orderBy("ord").drop("ord")
    elif sort_keys:
        out = out.orderBy(key)
    return out


def target_feature_split(df: DataFrame, features: Sequence[str], key: str = "id") -> DataFrame:
    """First feature -> ``label``, the rest -> ``features ARRAY<DOUBLE>``."""
    return df.select(F.col(key), F.col(features[0]).cast("double").alias("label"),
                     F.array(*[F.col(f).cast("double") for f in features[1:]]).alias("features"))


def drop_nonfinite_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Names of the columns free of null, NaN and ±inf (one aggregate pass)."""
    cols = list(columns) if columns is not None else _numeric(df)
    if not cols:
        return []
    row = df.agg(*[F.coalesce(F.bool_and(finite(F.col(c))), F.lit(True)).alias(c)
                   for c in cols]).first()
    return [c for c in cols if row[c]]


def finite(c: Column) -> Column:
    d = c.cast("double")
    return d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(float("inf")))


def missing_in_records(records: DataFrame, features: Sequence[str], values: str = "values") -> DataFrame:
    """(feature, n_missing, present): records whose map lacks each requested
    feature, counted in one pass; ``present`` when none does."""
    row = records.agg(*[F.count_if(~F.coalesce(F.map_contains_key(values, f), F.lit(False))).alias(f) for f in features])
    return (row.unpivot([], list(features), "feature", "n_missing")
            .withColumn("present", F.col("n_missing") == 0))


def check_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, present) for each requested feature against the frame's
    columns (the planning-time check behind ``feature_format``)."""
    have = set(df.columns)
    spark = df.sparkSession
    return spark.createDataFrame([(f, f in have) for f in features], "feature string, present boolean")
