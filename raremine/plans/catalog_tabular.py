"""Catalog part 1: keyed-table operators on the stand-in person table
(cleaning, projections, joins, statistics, windows, sorting, set operations,
scalar functions, resampling).  Each key has a Spark query and a SQL twin."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from raremine.functions.numeric import det_round, fmt_duration, hash_key, linspace_int, round_doubles
from raremine.operators import clean as C
from raremine.operators import features as FE
from raremine.operators import metrics as M
from raremine.operators import sampling as S
from raremine.operators import stats as ST
from raremine.operators.models import gnb_fold_predictions
from raremine.plans import oracle as O
from raremine.plans.standins import (EMAIL, NUMERIC, PERSON_CLEAN_SQL, TARGET, TRAIN_SQL,
                                     person_records, train_frame, with_ctes)
from raremine.sources.tables import read_table

Q: dict = {}
SQL: dict = {}

FEATS = NUMERIC + ["email_address_code"]          # predictors of the train frame
SMALL_FOLDS = 10


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def pclean(spark, sf):
    return C.clean_records(person_records(spark, sf), TARGET)


def pdata(spark, sf, features=NUMERIC):
    fmt = C.feature_format(C.drop_row_by_key(pclean(spark, sf)), [TARGET, *features])
    return fmt.withColumnRenamed(TARGET, "label")


def r(df, digits=6, **over):
    return round_doubles(df, digits, over)


def sel_r(cols, digits=6, prefix=""):
    return ", ".join(f"round(CAST({prefix}{c} AS DOUBLE), {digits}) AS {c}" for c in cols)


NUM_R = sel_r(NUMERIC)

# ------------------------------------------------------------------ 2.2 ----

@register("clean_sentinel_numeric", with_ctes(PERSON_CLEAN_SQL) + f" SELECT id, {NUM_R} FROM person_clean")
def q_clean_sentinel_numeric(spark, sf):
    return r(pclean(spark, sf).select("id", *NUMERIC))


@register("clean_bool_target", with_ctes(PERSON_CLEAN_SQL) + " SELECT id, poi FROM person_clean")
def q_clean_bool_target(spark, sf):
    return pclean(spark, sf).select("id", TARGET)


@register("clean_sentinel_string", with_ctes(PERSON_CLEAN_SQL) + " SELECT id, email_address FROM person_clean")
def q_clean_sentinel_string(spark, sf):
    return pclean(spark, sf).select("id", EMAIL)


@register("project_columns", with_ctes(PERSON_CLEAN_SQL) +
          " SELECT id, poi, round(total_price, 6) AS total_price, round(avg_price, 6) AS avg_price FROM person_clean")
def q_project_columns(spark, sf):
    return r(pclean(spark, sf).drop(EMAIL, "acctbal", "max_price", "min_price", "n_urgent", "n_high"))


@register("drop_row_by_key", with_ctes(PERSON_CLEAN_SQL) +
          " SELECT id, poi, round(total_price, 6) AS total_price FROM person_clean WHERE id <> 'TOTAL'")
def q_drop_row_by_key(spark, sf):
    return r(C.drop_row_by_key(pclean(spark, sf), "TOTAL").select("id", TARGET, "total_price"))


@register("impute_constant_col", with_ctes(PERSON_CLEAN_SQL) +
          " SELECT id, coalesce(email_address, '-1') AS email_address FROM person_clean")
def q_impute_constant_col(spark, sf):
    return C.impute_constant(pclean(spark, sf), -1, [EMAIL]).select("id", EMAIL)


@register("impute_constant_all", with_ctes(TRAIN_SQL) + f" SELECT id, {NUM_R} FROM train")
def q_impute_constant_all(spark, sf):
    return r(C.impute_constant(C.drop_row_by_key(pclean(spark, sf)), -1, NUMERIC).select("id", *NUMERIC))


@register("check_sentinel_free", with_ctes(PERSON_CLEAN_SQL) + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS column, coalesce(bool_or({c} = -1), false) AS present FROM person_clean WHERE id <> 'TOTAL'"
    for c in NUMERIC))
def q_check_sentinel_free(spark, sf):
    return C.check_sentinel_free(C.drop_row_by_key(pclean(spark, sf)), -1.0, NUMERIC)


@register("encode_label", with_ctes(TRAIN_SQL) + " SELECT id, email_address_code FROM train")
def q_encode_label(spark, sf):
    return train_frame(spark, sf, code=True).select("id", "email_address_code")


@register("ff_missing_to_zero", with_ctes(PERSON_CLEAN_SQL) + " SELECT id, CAST(poi AS DOUBLE) AS poi, " +
          ", ".join(f"round(coalesce({c}, 0.0), 6) AS {c}" for c in NUMERIC) + " FROM person_clean WHERE id <> 'TOTAL'")
def q_ff_missing_to_zero(spark, sf):
    return r(C.feature_format(C.drop_row_by_key(pclean(spark, sf)), [TARGET, *NUMERIC], remove_all_zeroes=False))


@register("ff_drop_all_zero", with_ctes(PERSON_CLEAN_SQL) +
          " SELECT id, CAST(poi AS DOUBLE) AS poi, coalesce(n_high, 0.0) AS n_high, coalesce(n_urgent, 0.0) AS n_urgent"
          " FROM person_clean WHERE id <> 'TOTAL' AND (coalesce(n_high, 0.0) <> 0 OR coalesce(n_urgent, 0.0) <> 0)")
def q_ff_drop_all_zero(spark, sf):
    return C.feature_format(C.drop_row_by_key(pclean(spark, sf)), [TARGET, "n_high", "n_urgent"])


@register("ff_drop_any_zero", with_ctes(PERSON_CLEAN_SQL) +
          " SELECT id, CAST(poi AS DOUBLE) AS poi, coalesce(n_high, 0.0) AS n_high, coalesce(n_urgent, 0.0) AS n_urgent,"
          " round(coalesce(acctbal, 0.0), 6) AS acctbal FROM person_clean WHERE id <> 'TOTAL'"
          " AND coalesce(n_high, 0.0) <> 0 AND coalesce(n_urgent, 0.0) <> 0 AND coalesce(acctbal, 0.0) <> 0")
def q_ff_drop_any_zero(spark, sf):
    return r(C.feature_format(C.drop_row_by_key(pclean(spark, sf)), [TARGET, "n_high", "n_urgent", "acctbal"],
                              remove_any_zeroes=True))


FORMATTED_SQL = ("fmt AS (SELECT id, total_price FROM person_clean WHERE id <> 'TOTAL' AND ("
                 + " OR ".join(f"coalesce({c}, 0.0) <> 0" for c in NUMERIC) + "))")


@register("ff_key_order", with_ctes(PERSON_CLEAN_SQL, FORMATTED_SQL) +
          " SELECT 'key' AS sort_keys, id, CAST(row_number() OVER (ORDER BY id) AS BIGINT) AS ord FROM fmt"
          " UNION ALL SELECT 'preset', id, CAST(row_number() OVER (ORDER BY total_price DESC NULLS LAST, id) AS BIGINT)"
          " FROM fmt WHERE total_price IS NOT NULL")
def q_ff_key_order(spark, sf):
    """Position of every formatted row: sorted by key, and in a preset key
    order (by falling total price; keys without one are not in the preset)."""
    clean = C.drop_row_by_key(pclean(spark, sf))
    features = [TARGET, *NUMERIC]
    by_key = C.global_row_number(C.feature_format(clean, features).select("id"), ["id"], "ord")
    priced = clean.filter(F.col("total_price").isNotNull()).select("id", (-F.col("total_price")).alias("_p"))
    preset = C.global_row_number(priced, ["_p", "id"], "ord").select("id", "ord")
    listed = C.feature_format(clean, features, sort_keys="preset", key_order=preset).select("id")
    # the preset may name rows that the zero test drops: number what is left in its order
    placed = C.global_row_number(listed.join(preset.withColumnRenamed("ord", "_o"), "id"), ["_o"], "ord")
    return (by_key.select(F.lit("key").alias("sort_keys"), "id", "ord")
            .unionByName(placed.select(F.lit("preset").alias("sort_keys"), "id", "ord")))


@register("target_feature_split", with_ctes(O.PERSON_DATA) +
          " SELECT id, label, CAST(j AS INTEGER) AS j, round(([" + ", ".join(NUMERIC) + "])[j + 1], 6) AS x"
          " FROM data, range(7) r(j)")
def q_target_feature_split(spark, sf):
    tfs = C.target_feature_split(pdata(spark, sf).withColumnRenamed("label", TARGET), [TARGET, *NUMERIC])
    return r(tfs.select("id", "label", F.posexplode("features").alias("j", "x")))


INTER_NAMES = FE.interaction_names(NUMERIC)


@register("drop_nonfinite_columns", with_ctes(TRAIN_SQL) + " " + " UNION ALL ".join(
    f"SELECT '{n}' AS column, bool_and({O.inter_sql(n)} IS NOT NULL AND isfinite({O.inter_sql(n)})) AS finite FROM train"
    for n in INTER_NAMES))
def q_drop_nonfinite_columns(spark, sf):
    inter = FE.interaction_features(train_frame(spark, sf), NUMERIC)
    kept = set(C.drop_nonfinite_columns(inter, INTER_NAMES))
    return spark.createDataFrame([(n, n in kept) for n in INTER_NAMES], "column string, finite boolean")


@register("scale_minmax", with_ctes(TRAIN_SQL, O.MINMAX_SQL) + f" SELECT id, {sel_r(FEATS)} FROM scaled")
def q_scale_minmax(spark, sf):
    return r(FE.scale_minmax(train_frame(spark, sf, code=True), FEATS).select("id", *FEATS))


@register("interaction_features", with_ctes(TRAIN_SQL, O.MINMAX_SQL) + " SELECT id, " + ", ".join(
    f'round(CAST({O.inter_sql(n)} AS DOUBLE), 6) AS "{n}"' for n in INTER_NAMES) + " FROM scaled")
def q_interaction_features(spark, sf):
    scaled = FE.scale_minmax(train_frame(spark, sf), NUMERIC)
    # the email code is the last column and takes no part (as in the reference)
    return r(FE.interaction_features(scaled, NUMERIC))


@register("interaction_features_array", with_ctes(TRAIN_SQL, O.MINMAX_SQL) + " " + " UNION ALL ".join(
    f"SELECT id, {i} AS position, round(CAST({O.inter_sql(n)} AS DOUBLE), 6) AS value FROM scaled" for i, n in enumerate(O.inter_order(NUMERIC))))
def q_interaction_features_array(spark, sf):
    """The interactions as one array column (scaled as an array, too): the form
    for many features, whose plan does not grow with them."""
    vectors = train_frame(spark, sf).select("id", F.array(*[F.col(c).cast("double") for c in NUMERIC]).alias("v"))
    inter = FE.interaction_array(FE.scale_array(vectors, "v"), "v")
    return r(inter.select("id", F.posexplode("interactions").alias("position", "value")))


@register("scale_standard", with_ctes(TRAIN_SQL) + " SELECT id, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1), 6) AS {c}"
    for c in NUMERIC) + " FROM train")
def q_scale_standard(spark, sf):
    return r(FE.scale_standard(train_frame(spark, sf), NUMERIC).select("id", *NUMERIC))


def scale_options_sql() -> str:
    fit = ", ".join(f"avg({c}) FILTER (WHERE NOT is_test) AS m_{c}, stddev_pop({c}) FILTER (WHERE NOT is_test) AS s_{c}"
                    for c in NUMERIC)
    value = ", ".join(f"round(({c} - CASE WHEN o.center THEN m_{c} ELSE 0 END)"
                      f" / CASE WHEN NOT o.scale OR s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}" for c in NUMERIC)
    return with_ctes(
        TRAIN_SQL, O.kfold_sql("train", "poi", 5, "kf"),
        "ex AS (SELECT f.fold, k.*, k.kfold = f.fold AS is_test FROM kf k CROSS JOIN range(5) f(fold))",
        f"st AS (SELECT fold, {fit} FROM ex GROUP BY fold)",
        "o AS (SELECT * FROM (VALUES (true, true), (true, false), (false, true), (false, false)) v(center, scale))",
    ) + (f" SELECT o.center, o.scale, CAST(ex.fold AS INTEGER) AS fold, id, is_test, {value}"
         " FROM ex JOIN st USING (fold) CROSS JOIN o")


@register("scale_options", scale_options_sql())
def q_scale_options(spark, sf):
    """Per-fold scaling with each combination of centring and division by the
    standard deviation, fitted on the fold's training rows."""
    kf = S.split_strat_kfold(train_frame(spark, sf), 5, label=TARGET).withColumnRenamed("fold", "kfold")
    ex = (kf.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(4))))
          .withColumn("is_test", F.col("kfold") == F.col("fold")))
    parts = [FE.scale_per_fold(ex, NUMERIC, center=center, scale=scale)
             .select(F.lit(center).alias("center"), F.lit(scale).alias("scale"), "fold", "id", "is_test", *NUMERIC)
             for center in (True, False) for scale in (True, False)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return r(out)


@register("add_missing_columns", with_ctes(TRAIN_SQL) +
          " SELECT id, round(acctbal * total_price, 6) AS acct_x_total, round(acctbal, 6) AS acctbal, poi FROM train")
def q_add_missing_columns(spark, sf):
    t = train_frame(spark, sf)
    derived = t.select("id", (F.col("acctbal") * F.col("total_price")).alias("acct_x_total"))
    return r(FE.add_missing_columns(derived, t, ["acct_x_total", "acctbal", TARGET]))


@register("threshold_label", with_ctes(TRAIN_SQL, O.MINMAX_SQL) +
          " SELECT id, CASE WHEN total_price > 0.5 THEN 1 ELSE 0 END AS pred FROM scaled")
def q_threshold_label(spark, sf):
    s = FE.scale_minmax(train_frame(spark, sf), NUMERIC)
    return s.select("id", M.threshold_label(F.col("total_price")).alias("pred"))


@register("relative_importance", with_ctes(TRAIN_SQL, O.anova_sql("train", NUMERIC, "poi", "fs")) +
          " SELECT feature, round(f, 6) AS f, round(100 * f / max(f) OVER (), 6) AS relative FROM fs")
def q_relative_importance(spark, sf):
    fs = ST.anova_f(train_frame(spark, sf), NUMERIC, TARGET)
    return r(FE.relative_importance(fs, "f"))


# ------------------------------------------------------------------ 2.3 ----

@register("join_index_align", with_ctes(TRAIN_SQL) +
          " SELECT coalesce(a.id, b.id) AS id, round(a.total_price, 6) AS total_price, b.n_urgent"
          " FROM (SELECT id, total_price FROM train WHERE poi = 1) a"
          " FULL OUTER JOIN (SELECT id, n_urgent FROM train WHERE n_urgent > 2) b ON a.id = b.id")
def q_join_index_align(spark, sf):
    t = train_frame(spark, sf)
    a = t.filter(F.col(TARGET) == 1).select("id", "total_price")
    b = t.filter(F.col("n_urgent") > 2).select("id", "n_urgent")
    return r(a.join(b, "id", "full"))


OUTLIER_SQL = O.outlier_sql("train", FEATS, 2.0, 4, "outl")


@register("outlier_rows_iqr", with_ctes(TRAIN_SQL, *OUTLIER_SQL) + " SELECT id, n_flags FROM outl")
def q_outlier_rows_iqr(spark, sf):
    return ST.outlier_rows_iqr(train_frame(spark, sf, code=True), FEATS, 2.0, 4)


@register("join_anti_outliers", with_ctes(TRAIN_SQL, *OUTLIER_SQL) +
          " SELECT id, poi FROM train WHERE id NOT IN (SELECT id FROM outl)")
def q_join_anti_outliers(spark, sf):
    t = train_frame(spark, sf, code=True)
    bad = ST.outlier_rows_iqr(t, FEATS, 2.0, 4).select("id")
    return t.join(bad, "id", "left_anti").select("id", TARGET)


@register("join_semi_membership", with_ctes(TRAIN_SQL, *OUTLIER_SQL) +
          " SELECT id, poi FROM train WHERE id IN (SELECT id FROM outl)")
def q_join_semi_membership(spark, sf):
    t = train_frame(spark, sf, code=True)
    bad = ST.outlier_rows_iqr(t, FEATS, 2.0, 4).select("id")
    return t.join(bad, "id", "left_semi").select("id", TARGET)


@register("join_fold_rows", with_ctes(PERSON_CLEAN_SQL, O.person_data_cte(),
                                      *O.strat_split_ctes(SMALL_FOLDS)[:-1]) +
          " SELECT CAST(rk.fold AS INTEGER) AS fold, rk.id, rk.rn <= sz.k AS is_test FROM rk JOIN sz USING (label)")
def q_join_fold_rows(spark, sf):
    d = pdata(spark, sf)
    test = S.split_strat_shuffle(d, SMALL_FOLDS).select("fold", "id", F.lit(True).alias("is_test"))
    allf = d.select("id").withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(SMALL_FOLDS - 1))))
    return (allf.join(test, ["fold", "id"], "left")
            .select(F.col("fold").cast("int"), "id", F.coalesce("is_test", F.lit(False)).alias("is_test")))


# ------------------------------------------------------------------ 2.4 ----

@register("agg_null_counts", with_ctes(PERSON_CLEAN_SQL) + ' SELECT "column", n_null FROM (' + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null FROM person_clean"
    for c in ["id", TARGET, EMAIL, *NUMERIC]) + ") WHERE n_null > 0")
def q_agg_null_counts(spark, sf):
    return ST.null_counts(pclean(spark, sf))


@register("agg_value_counts", with_ctes(TRAIN_SQL) +
          " SELECT poi AS value, CAST(count(*) AS BIGINT) AS count FROM train GROUP BY poi")
def q_agg_value_counts(spark, sf):
    return ST.value_counts(train_frame(spark, sf), TARGET)


@register("agg_shape", with_ctes(TRAIN_SQL) +
          " SELECT CAST(count(*) AS BIGINT) AS n_rows, 8 AS n_features FROM train")
def q_agg_shape(spark, sf):
    return ST.shape(train_frame(spark, sf, code=True), TARGET)


@register("agg_describe", with_ctes(TRAIN_SQL) + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 4) AS mean,"
    f" round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q25,"
    f" round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75,"
    f" round(max({c}), 4) AS max FROM train" for c in NUMERIC))
def q_agg_describe(spark, sf):
    return r(ST.describe(train_frame(spark, sf), NUMERIC), 4)


INFO_TYPES = [("id", "string"), (TARGET, "int"), *[(c, "double") for c in NUMERIC], ("email_address_code", "int")]


@register("agg_info", with_ctes(TRAIN_SQL) + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS non_null, '{t}' AS dtype FROM train" for c, t in INFO_TYPES))
def q_agg_info(spark, sf):
    return ST.info(train_frame(spark, sf, code=True))


@register("agg_quartiles", with_ctes(TRAIN_SQL) + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.75), 6) AS q3 FROM train"
    for c in FEATS))
def q_agg_quartiles(spark, sf):
    return r(ST.quartiles(train_frame(spark, sf, code=True), FEATS))


SPEAR_COLS = [TARGET, *NUMERIC]


@register("corr_spearman", with_ctes(TRAIN_SQL, *O.spearman_sql("train", SPEAR_COLS, "sp")) +
          " SELECT f1, f2, round(rho, 6) AS rho FROM sp")
def q_corr_spearman(spark, sf):
    mat = ST.spearman_matrix(train_frame(spark, sf), SPEAR_COLS)
    return r(ST.matrix_frame(spark, mat, SPEAR_COLS))


@register("arr_mask_diag", with_ctes(TRAIN_SQL, *O.spearman_sql("train", SPEAR_COLS, "sp")) +
          " SELECT f1, f2, round(rho, 6) AS rho FROM sp WHERE f1 <> f2")
def q_arr_mask_diag(spark, sf):
    mat = ST.spearman_matrix(train_frame(spark, sf), SPEAR_COLS)
    return r(ST.matrix_frame(spark, mat, SPEAR_COLS).filter(F.col("f1") != F.col("f2")))


def drop_correlated_sql(threshold: float = 0.93) -> str:
    inter = O.inter_order(NUMERIC)
    names = [*FEATS, "poi", *inter]
    exprs = [f"CAST({n} AS DOUBLE)" for n in [*FEATS, "poi"]] + [f"CAST({O.inter_sql(n)} AS DOUBLE)" for n in inter]
    long = " UNION ALL ".join(f"SELECT {j} AS j, '{n}' AS feature, id, {e} AS x FROM scaled"
                              for j, (n, e) in enumerate(zip(names, exprs)))
    return with_ctes(
        TRAIN_SQL, O.MINMAX_SQL,
        f"dl AS ({long})",
        "fin AS (SELECT j, feature FROM dl GROUP BY j, feature HAVING bool_and(x IS NOT NULL AND isfinite(x)))",
        "cols AS MATERIALIZED (SELECT row_number() OVER (ORDER BY j) - 1 AS j, feature AS name FROM fin)",
        "dr AS (SELECT d.feature, d.id, rank() OVER (PARTITION BY d.feature ORDER BY d.x) + (count(*) OVER"
        " (PARTITION BY d.feature, d.x) - 1) / CAST(2 AS DOUBLE) AS r FROM dl d JOIN fin USING (feature))",
        "corr_t AS MATERIALIZED (SELECT a.feature AS f1, b.feature AS f2, corr(a.r, b.r) AS rho FROM dr a JOIN dr b"
        " ON a.id = b.id AND a.feature <> b.feature GROUP BY a.feature, b.feature)",
        "walk(j, dropped) AS (SELECT 0, CAST([] AS VARCHAR[]) UNION ALL SELECT w.j + 1,"
        " CASE WHEN c.name = 'poi' OR list_contains(w.dropped, c.name) THEN w.dropped"
        " ELSE list_concat(w.dropped, coalesce((SELECT list(r.f2 ORDER BY r.f2) FROM corr_t r"
        f" WHERE r.f1 = c.name AND NOT isnan(r.rho) AND abs(r.rho) > {threshold} AND r.f2 <> 'poi'"
        " AND NOT list_contains(w.dropped, r.f2)), [])) END FROM walk w JOIN cols c ON c.j = w.j)",
    ).replace("WITH ", "WITH RECURSIVE ", 1) + (
        " SELECT c.name AS feature, NOT list_contains((SELECT dropped FROM walk ORDER BY j DESC LIMIT 1), c.name)"
        " AS kept FROM cols c")


@register("drop_correlated", drop_correlated_sql())
def q_drop_correlated(spark, sf):
    """Columns kept by the greedy |rho| > 0.93 walk over the min-max scaled
    features, the target (never dropped) and the interactions, in that order."""
    scaled = FE.scale_minmax(train_frame(spark, sf, code=True), FEATS)
    inter = FE.interaction_features(scaled, NUMERIC, keep=("id", *FEATS, TARGET))
    cols = C.drop_nonfinite_columns(inter, [*FEATS, TARGET, *INTER_NAMES])
    mat = ST.spearman_matrix(inter, cols)
    dropped = ST.drop_correlated(mat, cols, TARGET, 0.93)
    return spark.createDataFrame([(c, c not in dropped) for c in cols], "feature string, kept boolean")


@register("anova_f", with_ctes(TRAIN_SQL, O.anova_sql("train", NUMERIC, "poi", "fs")) +
          " SELECT feature, round(f, 6) AS f FROM fs")
def q_anova_f(spark, sf):
    return r(ST.anova_f(train_frame(spark, sf), NUMERIC, TARGET))


VIF_COLS = ["total_price", "avg_price", "acctbal"]


def vif_sql(threshold: float) -> str:
    """Diagonal of the inverse of a 3 x 3 correlation matrix, by cofactors."""
    a, b, c = VIF_COLS
    det = "(1 + 2 * ab * ac * bc - ab * ab - ac * ac - bc * bc)"
    one = " UNION ALL ".join(f"SELECT '{n}' AS feature, (1 - {r} * {r}) / {det} AS vif FROM k"
                             for n, r in ((a, "bc"), (b, "ac"), (c, "ab")))
    return with_ctes(TRAIN_SQL, f"k AS (SELECT corr({a}, {b}) AS ab, corr({a}, {c}) AS ac, corr({b}, {c}) AS bc FROM train)",
                     f"v AS ({one})") + f" SELECT feature, round(vif, 6) AS vif, NOT (vif > {threshold}) AS kept FROM v"


@register("vif_filter", vif_sql(1.2))
def q_vif_filter(spark, sf):
    kept, v = ST.vif_filter(train_frame(spark, sf), VIF_COLS, 1.2)
    return r(spark.createDataFrame([(c, v[c], c in kept) for c in VIF_COLS], "feature string, vif double, kept boolean"))


def _gnb_pred(spark, sf, folds=SMALL_FOLDS):
    return gnb_fold_predictions(pdata(spark, sf), NUMERIC, folds)


PRED_CTES = [PERSON_CLEAN_SQL, O.person_data_cte()] + O.strat_split_ctes(SMALL_FOLDS) + O.gnb_fold_pred_ctes(NUMERIC)


@register("confusion_counts", with_ctes(*PRED_CTES) +
          " SELECT CAST(count(*) AS BIGINT) AS total,"
          " CAST(count(*) FILTER (WHERE prediction = 1 AND label = 1) AS BIGINT) AS tp,"
          " CAST(count(*) FILTER (WHERE prediction = 1 AND label = 0) AS BIGINT) AS fp,"
          " CAST(count(*) FILTER (WHERE prediction = 0 AND label = 1) AS BIGINT) AS fn,"
          " CAST(count(*) FILTER (WHERE prediction = 0 AND label = 0) AS BIGINT) AS tn FROM pred")
def q_confusion_counts(spark, sf):
    return M.confusion_counts(_gnb_pred(spark, sf))


@register("confusion_metrics", with_ctes(*PRED_CTES) + O.counts_metrics_select("pred"))
def q_confusion_metrics(spark, sf):
    return r(M.confusion_metrics(M.confusion_counts(_gnb_pred(spark, sf))))


F1_SQL = ("f1t AS (SELECT CAST(fold AS INTEGER) AS fold,"
          " count(*) FILTER (WHERE prediction = 1 AND label = 1) AS tp,"
          " count(*) FILTER (WHERE prediction = 1 AND label = 0) AS fp,"
          " count(*) FILTER (WHERE prediction = 0 AND label = 1) AS fn FROM pred GROUP BY fold)",
          "f1s AS (SELECT fold, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,"
          " coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall FROM f1t)")


@register("metric_f1_prec_rec", with_ctes(*PRED_CTES, *F1_SQL) +
          " SELECT fold, round(f1, 6) AS f1, round(precision, 6) AS precision, round(recall, 6) AS recall FROM f1s")
def q_metric_f1_prec_rec(spark, sf):
    return r(M.f1_prec_rec(_gnb_pred(spark, sf), group=["fold"]).withColumn("fold", F.col("fold").cast("int")))


@register("metric_confusion_matrix", with_ctes(*PRED_CTES) +
          " SELECT CAST(label AS INTEGER) AS actual, CAST(count(*) FILTER (WHERE prediction = 0) AS BIGINT) AS pred_0,"
          " CAST(count(*) FILTER (WHERE prediction = 1) AS BIGINT) AS pred_1 FROM pred GROUP BY label")
def q_metric_confusion_matrix(spark, sf):
    return M.confusion_matrix(_gnb_pred(spark, sf))


@register("fold_summary", with_ctes(*PRED_CTES, *F1_SQL) +
          " SELECT round(avg(f1), 6) AS f1_mean, round(3 * stddev_pop(f1), 6) AS f1_3std FROM f1s")
def q_fold_summary(spark, sf):
    scores = M.f1_prec_rec(_gnb_pred(spark, sf), group=["fold"])
    return r(M.fold_summary(scores, [], ["f1"]))


@register("agg_best_round", with_ctes(*PRED_CTES, *F1_SQL) +
          " SELECT round(max(f1), 6) AS best_f1, CAST(first(fold ORDER BY f1 DESC, fold) AS INTEGER) AS best_fold FROM f1s")
def q_agg_best_round(spark, sf):
    scores = M.f1_prec_rec(_gnb_pred(spark, sf), group=["fold"])
    return r(scores.agg(F.max("f1").alias("best_f1"),
                        F.max_by(F.col("fold"), F.struct(F.col("f1"), -F.col("fold"))).cast("int").alias("best_fold")))


@register("metric_roc_auc", with_ctes(TRAIN_SQL,
                                      "rk AS (SELECT poi, rank() OVER (ORDER BY total_price) + (count(*) OVER (PARTITION BY total_price) - 1) / CAST(2 AS DOUBLE) AS ar FROM train)") +
          " SELECT round((sum(ar) FILTER (WHERE poi = 1) - count_if(poi = 1) * (count_if(poi = 1) + 1) / CAST(2 AS DOUBLE))"
          " / (count_if(poi = 1) * count_if(poi = 0)), 6) AS auc FROM rk")
def q_metric_roc_auc(spark, sf):
    return r(M.roc_auc(train_frame(spark, sf), label=TARGET, score="total_price"))


@register("agg_class_counts",
          "WITH d AS (SELECT l.quality AS label, d.doc_id FROM documents d JOIN labels l ON d.doc_id = l.doc_id),"
          " h AS (SELECT *, NOT (row_number() OVER (ORDER BY md5(concat_ws('|', '42', CAST(doc_id AS VARCHAR))),"
          " doc_id) <= ceil(0.1 * count(*) OVER ())) AS is_train FROM d)"
          " SELECT CAST(sum(label) AS BIGINT) AS n_pos, CAST(count(*) - sum(label) AS BIGINT) AS n_neg"
          " FROM h WHERE is_train")
def q_agg_class_counts(spark, sf):
    """Class counts of the text training split (labelled documents, 90 %)."""
    d = read_table(spark, sf, "documents").select("doc_id").join(
        read_table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id")
    train = S.split_holdout(d, 0.1, key="doc_id").filter(~F.col("is_test"))
    return train.agg(F.sum("label").cast("long").alias("n_pos"),
                     (F.count(F.lit(1)) - F.sum("label")).cast("long").alias("n_neg"))


# ------------------------------------------------------------------ 2.5 ----

@register("win_cumulative_sum", with_ctes(TRAIN_SQL, O.anova_sql("train", NUMERIC, "poi", "fs")) +
          " SELECT feature, round(f, 6) AS f, round(sum(f) OVER (ORDER BY f DESC, feature ROWS UNBOUNDED PRECEDING)"
          " / sum(f) OVER (), 6) AS cum_share FROM fs")
def q_win_cumulative_sum(spark, sf):
    fs = ST.anova_f(train_frame(spark, sf), NUMERIC, TARGET)
    # a window over the p-row score table (bounded by the number of features)
    w = Window.orderBy(F.desc("f"), "feature").rowsBetween(Window.unboundedPreceding, 0)
    tot = Window.partitionBy()
    return r(fs.select("feature", "f", (F.sum("f").over(w) / F.sum("f").over(tot)).alias("cum_share")))


@register("win_prefix_rows", with_ctes(TRAIN_SQL, O.kfold_sql("train", "poi", 5, "kf")) +
          " SELECT CAST(fold AS INTEGER) AS fold, id FROM (SELECT f.fold, k.id, row_number() OVER"
          " (PARTITION BY f.fold ORDER BY k.id) AS rn FROM kf k JOIN range(5) f(fold) ON k.kfold <> f.fold) WHERE rn <= 20")
def q_win_prefix_rows(spark, sf):
    kf = S.split_strat_kfold(train_frame(spark, sf), 5, label=TARGET).withColumnRenamed("fold", "kfold")
    ex = (kf.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(4))))
          .filter(F.col("kfold") != F.col("fold")))
    w = Window.partitionBy("fold").orderBy("id")
    return (ex.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= 20)
            .select(F.col("fold").cast("int"), "id"))


# ------------------------------------------------------------------ 2.6 ----

@register("sort_desc", with_ctes(TRAIN_SQL, O.anova_sql("train", NUMERIC, "poi", "fs")) +
          " SELECT feature, round(f, 6) AS f FROM fs ORDER BY f DESC")
def q_sort_desc(spark, sf):
    return r(ST.anova_f(train_frame(spark, sf), NUMERIC, TARGET).orderBy(F.desc("f")))


@register("sort_index_desc", with_ctes(TRAIN_SQL, O.anova_sql("train", NUMERIC, "poi", "fs")) +
          " SELECT string_agg(feature, ',' ORDER BY f DESC, feature) AS ranked FROM fs")
def q_sort_index_desc(spark, sf):
    fs = ST.anova_f(train_frame(spark, sf), NUMERIC, TARGET)
    # the score table has one row per feature
    return fs.agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct(-F.col("f"), F.col("feature")))), lambda s: s["feature"]), ",")
        .alias("ranked"))


@register("select_k_best", with_ctes(TRAIN_SQL, O.anova_sql("train", NUMERIC, "poi", "fs")) +
          " SELECT feature, round(f, 6) AS f FROM fs ORDER BY f DESC NULLS LAST, feature LIMIT 3")
def q_select_k_best(spark, sf):
    return r(ST.select_k_best(ST.anova_f(train_frame(spark, sf), NUMERIC, TARGET), 3))


@register("select_percentile", with_ctes(TRAIN_SQL, O.anova_sql("train", NUMERIC, "poi", "fs"),
                                         "thr AS (SELECT quantile_cont(f, 0.5) AS t FROM fs)") +
          " SELECT feature, round(f, 6) AS f FROM fs, thr WHERE f > t UNION ALL"
          " SELECT feature, round(f, 6) AS f FROM (SELECT feature, f, row_number() OVER (ORDER BY feature) AS rn"
          " FROM fs, thr WHERE f = t) WHERE rn <= 3 - (SELECT count(*) FROM fs, thr WHERE f > t)")
def q_select_percentile(spark, sf):
    return r(ST.select_percentile(ST.anova_f(train_frame(spark, sf), NUMERIC, TARGET), 50.0))


@register("sample_rows", with_ctes(TRAIN_SQL) +
          " SELECT id, poi FROM train ORDER BY md5(concat_ws('|', '42', id)) LIMIT 10")
def q_sample_rows(spark, sf):
    t = train_frame(spark, sf)
    return t.orderBy(hash_key(42, F.col("id"))).limit(10).select("id", TARGET)


# ------------------------------------------------------------------ 2.7 ----

@register("oversample_duplicate", with_ctes(TRAIN_SQL) +
          " SELECT id, poi, round(total_price, 6) AS total_price FROM train"
          " CROSS JOIN range(4) c(i) WHERE poi = 1 OR c.i = 0")
def q_oversample_duplicate(spark, sf):
    return r(S.oversample_duplicate(train_frame(spark, sf), passes=2, label=TARGET)
             .select("id", TARGET, "total_price"))


@register("set_union_distinct", with_ctes(TRAIN_SQL) +
          " SELECT id FROM train WHERE poi = 1 UNION SELECT id FROM train WHERE n_urgent > 3")
def q_set_union_distinct(spark, sf):
    t = train_frame(spark, sf)
    return t.filter(F.col(TARGET) == 1).select("id").union(t.filter(F.col("n_urgent") > 3).select("id")).distinct()


# ------------------------------------------------------------------ 2.8 ----

@register("fmt_duration",
          "SELECT user_id, printf('%.0f:%.0f:%.1f', floor(d / 3600), floor((d % 3600) / 60), d % 60) AS duration"
          " FROM (SELECT user_id, round(epoch(max(ts)) - epoch(min(ts)), 1) AS d FROM events GROUP BY user_id)")
def q_fmt_duration(spark, sf):
    ev = read_table(spark, sf, "events")
    span = ev.groupBy("user_id").agg(
        det_round(F.unix_micros(F.max("ts").cast("timestamp")) / 1e6 - F.unix_micros(F.min("ts").cast("timestamp")) / 1e6, 1).alias("d"))
    return span.select("user_id", fmt_duration(F.col("d")).alias("duration"))


@register("math_pairwise", with_ctes(TRAIN_SQL, O.MINMAX_SQL) +
          " SELECT id, round(acctbal * total_price, 6) AS prod, round(acctbal + total_price, 6) AS sum,"
          " round(acctbal / total_price, 6) AS ratio, round(acctbal - total_price, 6) AS diff FROM scaled")
def q_math_pairwise(spark, sf):
    s = FE.scale_minmax(train_frame(spark, sf), NUMERIC)
    a, b = F.col("acctbal"), F.col("total_price")
    return r(s.select("id", (a * b).alias("prod"), (a + b).alias("sum"),
                      F.try_divide(a, b).alias("ratio"), (a - b).alias("diff")))


@register("math_abs_round", with_ctes(TRAIN_SQL) +
          " SELECT id, round(abs(acctbal - 5000), 2) AS abs_dev, round(avg_price / 1000, 3) AS r3 FROM train")
def q_math_abs_round(spark, sf):
    t = train_frame(spark, sf)
    return t.select("id", det_round(F.abs(F.col("acctbal") - 5000), 2).alias("abs_dev"),
                    det_round(F.col("avg_price") / 1000, 3).alias("r3"))


@register("pred_finite", with_ctes(TRAIN_SQL) +
          " SELECT id, q IS NULL AS is_null, coalesce(isnan(q), false) AS is_nan,"
          " coalesce(isfinite(q), false) AS is_finite FROM (SELECT id, CASE WHEN n_high <> 0 THEN n_urgent / n_high END AS q FROM train)")
def q_pred_finite(spark, sf):
    t = train_frame(spark, sf).select("id", F.try_divide(F.col("n_urgent"), F.col("n_high")).alias("q"))
    return t.select("id", F.col("q").isNull().alias("is_null"),
                    F.coalesce(F.isnan("q"), F.lit(False)).alias("is_nan"),
                    C.finite(F.col("q")).alias("is_finite"))


@register("arr_linspace", with_ctes(TRAIN_SQL) +
          " SELECT CAST(i AS INTEGER) AS i, CAST(trunc(20 + i * (m - 20) / CAST(9 AS DOUBLE)) AS INTEGER) AS size"
          " FROM (SELECT CAST(floor(count(*) * 0.9) AS BIGINT) AS m FROM train), range(10) r(i)")
def q_arr_linspace(spark, sf):
    t = train_frame(spark, sf)
    m = t.agg(F.floor(F.count(F.lit(1)) * 0.9).alias("m"))
    return m.select(F.posexplode(linspace_int(20, F.col("m"), 10)).alias("i", "size"))


@register("map_lookup",
          "SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events")
def q_map_lookup(spark, sf):
    ev = read_table(spark, sf, "events")
    m = F.from_json("props", "map<string,string>")
    return ev.select("event_id", F.element_at(m, F.lit("k")).alias("k"))


# ------------------------------------------------------------------ 2.9 ----

@register("split_holdout", with_ctes(TRAIN_SQL) +
          " SELECT id, row_number() OVER (ORDER BY md5(concat_ws('|', '42', id)), id) <= ceil(0.1 * count(*) OVER ())"
          " AS is_test FROM train")
def q_split_holdout(spark, sf):
    return S.split_holdout(train_frame(spark, sf), 0.1).select("id", "is_test")


@register("split_strat_shuffle", with_ctes(PERSON_CLEAN_SQL, O.person_data_cte(), *O.strat_split_ctes(SMALL_FOLDS)) +
          " SELECT CAST(fold AS INTEGER) AS fold, id, label FROM test")
def q_split_strat_shuffle(spark, sf):
    t = S.split_strat_shuffle(pdata(spark, sf), SMALL_FOLDS)
    return t.select(F.col("fold").cast("int"), "id", "label")


@register("split_strat_kfold", with_ctes(TRAIN_SQL, O.kfold_sql("train", "poi", 5, "kf")) +
          " SELECT id, CAST(kfold AS INTEGER) AS fold FROM kf")
def q_split_strat_kfold(spark, sf):
    return S.split_strat_kfold(train_frame(spark, sf), 5, label=TARGET).select("id", "fold")


@register("class_weight_balanced", with_ctes(TRAIN_SQL) +
          " SELECT id, poi, round(count(*) OVER () / (CAST(2 AS DOUBLE) * count(*) OVER (PARTITION BY poi)), 6) AS weight FROM train")
def q_class_weight_balanced(spark, sf):
    return r(S.class_weight_balanced(train_frame(spark, sf), TARGET).select("id", TARGET, "weight"))
