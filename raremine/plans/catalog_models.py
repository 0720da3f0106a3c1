"""Catalog part 2: neighbours, oversampling, classifiers, PCA and the
evaluation workflows (model comparison, searches, learning curves, boosting
rounds, hold-out trees)."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raremine.functions.numeric import det_round, round_doubles
from raremine.operators import features as FE
from raremine.operators import learners as L
from raremine.operators import metrics as M
from raremine.operators import neighbors as NB
from raremine.operators import sampling as S
from raremine.operators import trees as TR
from raremine.operators.models import gnb_fit, gnb_predict
from raremine.plans import oracle as O
from raremine.plans.catalog_tabular import FEATS, pdata
from raremine.plans.standins import NUMERIC, TARGET, TRAIN_SQL, train_frame, with_ctes
from raremine.session import written
from raremine.sources.tables import read_table

Q: dict = {}
SQL: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def r(df, digits=6):
    return round_doubles(df, digits)


def scaled_train(spark, sf) -> DataFrame:
    return FE.scale_minmax(train_frame(spark, sf, code=True), FEATS)


def dist2_sql(a: str, b: str, cols) -> str:
    return " + ".join(f"pow({a}.{c} - {b}.{c}, 2)" for c in cols)


# ------------------------------------------------------------- neighbours --

@register("join_knn",
          "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),"
          " p AS (SELECT a.vec_id AS qid, b.vec_id AS rid, list_distance(a.v, b.v) AS dist"
          " FROM e a JOIN e b ON a.vec_id <> b.vec_id),"
          " k AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, rid) AS rank FROM p)"
          " SELECT qid, rid, CAST(rank AS INTEGER) AS rank, round(dist, 6) AS dist FROM k WHERE rank <= 5")
def q_join_knn(spark, sf):
    e = read_table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return r(NB.knn_join(e, e, 5, "vec_id", "vec_id", "v"))


HOLDOUT_CTE = ("h AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', id)), id)"
               " <= ceil(0.1 * count(*) OVER ()) AS is_test FROM scaled)")


@register("clf_knn", with_ctes(TRAIN_SQL, O.MINMAX_SQL, HOLDOUT_CTE,
                               "te AS (SELECT * FROM h WHERE is_test)", "tr AS (SELECT * FROM h WHERE NOT is_test)",
                               f"p AS (SELECT te.id AS qid, tr.id AS rid, tr.poi AS nl, {dist2_sql('te', 'tr', FEATS)} AS d2 FROM te, tr)",
                               "k AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, rid) AS rk FROM p)",
                               "v AS (SELECT qid, nl, count(*) AS votes FROM k WHERE rk <= 5 GROUP BY qid, nl)",
                               "b AS (SELECT qid, first(nl ORDER BY votes DESC, nl) AS prediction FROM v GROUP BY qid)") +
          " SELECT te.id, te.poi, b.prediction FROM te JOIN b ON te.id = b.qid")
def q_clf_knn(spark, sf):
    s = S.split_holdout(scaled_train(spark, sf)).withColumn("v", NB.as_vector(FEATS))
    return NB.knn_vote(s.filter("is_test"), s.filter("not is_test"), 5, "id", TARGET, "v")


SMOTE_SQL = [
    "base AS (SELECT * FROM scaled)",
    "mn AS (SELECT * FROM base WHERE poi = 1)",
    f"d_all AS (SELECT a.id AS qid, b.id AS rid, b.poi AS rl, {dist2_sql('a', 'b', NUMERIC)} AS d2"
    " FROM mn a JOIN base b ON a.id <> b.id)",
    "nn_all AS (SELECT qid, rl FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, rid) AS rk"
    " FROM d_all) WHERE rk <= 10)",
    "danger AS (SELECT qid FROM nn_all GROUP BY qid HAVING count(*) FILTER (WHERE rl <> 1) >= 5"
    " AND count(*) FILTER (WHERE rl <> 1) < 10)",
    f"pr AS (SELECT a.id AS qid, b.id AS rid, {dist2_sql('a', 'b', NUMERIC)} AS d2 FROM mn a JOIN mn b"
    " ON a.id <> b.id WHERE a.id IN (SELECT qid FROM danger))",
    "pairs AS (SELECT qid, rid FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, rid) AS rk"
    " FROM pr) WHERE rk <= 5)",
    "cnt AS (SELECT (SELECT count(*) FROM base WHERE poi <> 1) - (SELECT count(*) FROM base WHERE poi = 1) AS n_new,"
    " (SELECT count(*) FROM pairs) AS np)",
    "prk AS (SELECT p.qid, p.rid, row_number() OVER (ORDER BY md5(concat_ws('|', '42', qid, rid)), qid, rid) AS prn"
    " FROM pairs p)",
    "ch AS (SELECT qid, rid, unnest(range(CAST(n_new // np + CASE WHEN prn <= n_new % np THEN 1 ELSE 0 END AS BIGINT)))"
    " AS copy FROM prk, cnt)",
    "u AS (SELECT ch.*, CAST(('0x' || substr(md5(concat_ws('|', '42', qid, rid, CAST(copy AS VARCHAR))), 1, 8)) AS BIGINT)"
    " / CAST(4294967296 AS DOUBLE) AS u FROM ch)",
]


@register("smote_borderline", with_ctes(TRAIN_SQL, O.MINMAX_SQL, *SMOTE_SQL) +
          " SELECT concat_ws('|', 'smote', qid, rid, CAST(copy AS VARCHAR)) AS id, qid AS source, rid AS neighbour,"
          " CAST(copy AS INTEGER) AS copy, " +
          ", ".join(f"round(x.{c} + u.u * (n.{c} - x.{c}), 6) AS {c}" for c in NUMERIC) +
          ", 1 AS poi FROM u JOIN base x ON x.id = u.qid JOIN base n ON n.id = u.rid")
def q_smote_borderline(spark, sf):
    return r(NB.smote_borderline(scaled_train(spark, sf), NUMERIC, TARGET, "id"))


# ------------------------------------------------------------- classifiers --

def _holdout(spark, sf, test_size=0.1):
    return S.split_holdout(pdata(spark, sf), test_size)


GNB_HOLDOUT_SQL = [
    O.person_data_cte(),
    "h AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', id)), id)"
    " <= ceil(0.1 * count(*) OVER ()) AS is_test FROM data)",
    "g AS (SELECT label AS cls, count(*) AS n, " + ", ".join(
        f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in NUMERIC) + " FROM h WHERE NOT is_test GROUP BY label)",
    "e AS (SELECT 1e-9 * greatest(" + ", ".join(f"var_pop({c})" for c in NUMERIC) + ") AS eps,"
    " count(*) AS ntot FROM h WHERE NOT is_test)",
    "sc AS (SELECT h.id, h.label, g.cls, ln(g.n / e.ntot) - 0.5 * (" + " + ".join(
        f"ln(2 * pi() * (g.v_{c} + e.eps))" for c in NUMERIC) + ") - 0.5 * (" + " + ".join(
        f"pow(h.{c} - g.m_{c}, 2) / (g.v_{c} + e.eps)" for c in NUMERIC) + ") AS jll FROM h, g, e WHERE h.is_test)",
]


@register("clf_gaussian_nb", with_ctes(O.PERSON_CLEAN_SQL, *GNB_HOLDOUT_SQL) +
          " SELECT id, label, cls AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY jll DESC, cls)"
          " AS rr FROM sc) WHERE rr = 1")
def q_clf_gaussian_nb(spark, sf):
    h = _holdout(spark, sf)
    model = gnb_fit(h.filter(~F.col("is_test")), NUMERIC)
    return gnb_predict(h.filter("is_test"), model).select("id", "label", F.col("prediction").cast("double"))


def _ml_holdout(name, **params):
    def q(spark, sf):
        h = _holdout(spark, sf)
        pred, _, _ = L.fit_predict(name, h.filter(~F.col("is_test")), h.filter("is_test"), NUMERIC, **params)
        return pred
    q.__name__ = f"q_clf_{name}"
    return q


register("clf_logistic")(_ml_holdout("logistic", C=1.0))
register("clf_linear_svc")(_ml_holdout("linear_svc", C=1.0, balanced=True))
register("clf_random_forest")(_ml_holdout("random_forest", numTrees=20, maxDepth=5))
BOOSTED = dict(max_depth=3, step=0.05, max_iter=50)


@register("clf_boosted_trees")
def q_clf_boosted_trees(spark, sf):
    """Boosted trees that stop early: a tenth of the training rows tells when
    the loss no longer falls."""
    h = _holdout(spark, sf)
    model = TR.fit_boosted(h.filter(~F.col("is_test")), NUMERIC, **BOOSTED)
    pred = model.transform(L.assemble(h.filter("is_test"), NUMERIC))
    return pred.select("id", "label", F.col("prediction").cast("double"))


@register("clf_kernel_svc")
def q_clf_kernel_svc(spark, sf):
    """RBF SVC re-aimed: random Fourier features (gamma 0.1) + LinearSVC."""
    h = FE.scale_standard(_holdout(spark, sf), NUMERIC)
    z, names = L.random_fourier_features(h, NUMERIC, n_out=64, gamma=0.1)
    pred, _, _ = L.fit_predict("linear_svc", z.filter(~F.col("is_test")), z.filter("is_test"), names, regParam=0.01)
    return pred


def _split_counts(spark, sf) -> DataFrame:
    """(feature, importance) of boosted trees fitted on 70 % of the rows."""
    h = _holdout(spark, sf, 0.3)
    model = TR.fit_boosted(h.filter(~F.col("is_test")), NUMERIC, **BOOSTED)
    return TR.split_counts(TR.tree_nodes(model, spark), NUMERIC)


@register("feature_importance")
def q_feature_importance(spark, sf):
    """How many nodes of the trees split on each feature; features that no node
    uses are left out, as in the reference."""
    return _split_counts(spark, sf)


@register("select_by_importance")
def q_select_by_importance(spark, sf):
    """Keep features whose split count is above 10 % of the largest (joined on
    the feature name, not on sorted positions)."""
    rel = FE.relative_importance(_split_counts(spark, sf), "importance")
    return r(rel.filter(F.col("relative") > 10.0))


def _entries(e: DataFrame) -> list[str]:
    """A column name per entry of the embeddings, however long they are."""
    return [f"e{i}" for i in range(e.agg(F.max(F.size("embedding"))).first()[0])]


@register("pca_explained_variance")
def q_pca_explained_variance(spark, sf):
    e = read_table(spark, sf, "embeddings")
    cols = _entries(e)
    wide = e.select(*[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cols)])
    _, _, _, explained = L.pca_fit(wide, cols)
    rows = [(i + 1, float(v)) for i, v in enumerate(explained)]
    df = spark.createDataFrame(rows, "component int, explained double")
    from pyspark.sql import Window
    w = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)   # p rows
    return r(df.select("component", det_round("explained", 3).alias("explained"),
                       F.sum("explained").over(w).alias("cumulative")))


@register("pca")
def q_pca(spark, sf):
    """Scores on the fewest components reaching 96 % of the variance."""
    e = read_table(spark, sf, "embeddings")
    cols = _entries(e)
    wide = e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cols)])
    model, means, k, _ = L.pca_fit(wide, cols, 0.96)
    return r(L.pca_transform(wide, cols, model, means, k, keep=["vec_id"]))


# ---------------------------------------------------------- evaluation ----

def _fold_frames(data: DataFrame, folds: int, label: str = "label", parallelism: int = 4):
    """(fold, train, test) for stratified shuffle splits (test rows by md5), each
    written once: a fit then runs as many tasks as its rows need in every one
    of its passes, not one per shuffle partition."""
    from concurrent.futures import ThreadPoolExecutor

    test = S.split_strat_shuffle(data, folds, label=label, keep=[c for c in data.columns if c not in ("id", label)])

    def frames(f):
        te = written(test.filter(F.col("fold") == f).drop("fold"), "fold-test")
        return f, written(data.join(te.select("id"), "id", "left_anti"), "fold-train"), te

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(frames, range(folds)))


COMPARE_MODELS = ["gaussian_nb", "logistic", "linear_svc", "kernel_svc", "random_forest", "boosted_trees", "knn"]


def compare_models(spark, data: DataFrame, features, folds: int = 10, models=COMPARE_MODELS,
                   parallelism: int = 4, timings: bool = False) -> DataFrame:
    """Leaderboard: model, train/test F1 mean, 3 x std of test F1 and, on
    request, the mean fit time.  Linear models use C = 1.  The (fold, model) fits are independent Spark jobs submitted from a
    small thread pool (Spark schedules concurrent jobs), like the reference's
    parallel cross-validation; the SVCs of all folds, and their neighbours, share jobs."""
    from concurrent.futures import ThreadPoolExecutor

    data = written(data, "compare")
    frames = _fold_frames(data, folds, parallelism=parallelism)

    def stacked(i):
        """Training (1) or test (2) rows of all folds."""
        return reduce(DataFrame.unionByName, [x[i].withColumn("fold", F.lit(x[0])) for x in frames])

    def of_folds(name, p_tr, p_te, fit_s):
        f_tr, f_te = ({x["fold"]: x["f1"] for x in M.f1_prec_rec(p, group=["fold"]).collect()} for p in (p_tr, p_te))
        return [(name, f, float(f_tr.get(f, 0.0)), float(f_te.get(f, 0.0)), float(fit_s)) for f in range(folds)]

    def run(task):
        name, *fold = task
        t0 = time.time()
        if name == "knn":
            v = NB.as_vector(features)
            trv, tev, rows = (x.withColumn("v", v) for x in (stacked(1), stacked(2), data))
            # neighbours among all rows, of which a fold's are the first that it trains
            near = written(NB.knn_join(rows, rows, 4 * 5, "id", "id", "v", exclude_self=False), "compare-near")
            p_tr, p_te = (NB.knn_vote(x, rows, 5, "id", "label", "v", "fold", tev, folds, near) for x in (trv, tev))
            return of_folds(name, p_tr, p_te, (time.time() - t0) / folds)
        if name == "kernel_svc":
            # RBF kernel re-aimed: the same seeded random Fourier map on both sides
            z, names = L.random_fourier_features(data, features, n_out=64, gamma=0.1)
            zte, _ = L.random_fourier_features(stacked(2), features, n_out=64, gamma=0.1)
            p_te, fit_s, p_tr = L.fit_predict("linear_svc", z, zte, names, C=1.0, splits=folds)
            return of_folds(name, p_tr, p_te, fit_s)
        if name == "linear_svc":
            p_te, fit_s, p_tr = L.fit_predict(name, data, stacked(2), features, C=1.0, splits=folds)
            return of_folds(name, p_tr, p_te, fit_s)
        f, tr, te = fold
        p_te, fit_s, model = L.fit_predict(name, tr, te, features, **({"C": 1.0} if name in L.LINEAR else {}))
        p_tr = model.transform(L.assemble(tr, features)).select("id", "label", "prediction")
        f_te = M.f1_prec_rec(p_te).first()["f1"]
        f_tr = M.f1_prec_rec(p_tr).first()["f1"]
        return [(name, f, float(f_tr), float(f_te), float(fit_s))]

    at_once = ("kernel_svc", "linear_svc", "knn")
    tasks = [(name,) for name in at_once if name in models] + [(name, *x) for x in frames for name in models if name not in at_once]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        rows = [x for part in pool.map(run, tasks) for x in part]
    res = spark.createDataFrame(rows, "model string, fold int, train_f1 double, test_f1 double, fit_s double")
    return (res.groupBy("model").agg(F.avg("train_f1").alias("train_f1_mean"), F.avg("test_f1").alias("test_f1_mean"),
                                     (3 * F.stddev_pop("test_f1")).alias("test_f1_3std"),
                                     *[F.avg("fit_s").alias("fit_time_mean")] * timings)
            .orderBy(F.desc("test_f1_mean")))


@register("compare_models")
def q_compare_models(spark, sf):
    data = FE.scale_minmax(pdata(spark, sf), NUMERIC)
    return r(compare_models(spark, data, NUMERIC))


F1_EVAL = dict(metricName="fMeasureByLabel", metricLabel=1.0, labelCol="label", predictionCol="prediction")


def cv_search(data: DataFrame, features, name: str, grid: list[dict], k: int = 3, parallelism: int = 4):
    """CrossValidator over an explicit list of parameter settings; folds from
    the md5 stratified k-fold (``foldCol``), written once: every pass of a fit
    is as many tasks as the rows need.  Returns [(params, mean F1)]."""
    est = L.make_estimator(name)
    pg = ParamGridBuilder()
    maps = []
    for g in grid:
        maps.append({est.getParam(k_): v for k_, v in g.items()})
    folded = written(S.split_strat_kfold(L.assemble(data, features), k), "folds")
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps or pg.build(),
                        evaluator=MulticlassClassificationEvaluator(**F1_EVAL),
                        foldCol="fold", parallelism=parallelism, seed=42)
    model = cv.fit(folded)
    return [(g, float(m)) for g, m in zip(grid, model.avgMetrics)], model


NESTED_GRID = [{"regParam": rp, "elasticNetParam": en} for rp in (0.0, 0.01, 0.1) for en in (0.0, 0.5)]
SEARCH_GRID = {"logistic": [{"regParam": v} for v in (0.0, 0.01, 0.1)],
               "linear_svc": [{"regParam": v} for v in (0.01, 0.1)]}


def _search_rows(spark, results):
    return spark.createDataFrame(
        [(m, str(sorted(g.items())), s) for m, res in results for g, s in res],
        "model string, params string, mean_f1 double")


@register("grid_search")
def q_grid_search(spark, sf):
    """Pipeline(F-test selector, logistic regression) over a grid of
    (top features, regularisation), 3-fold md5-stratified CV on F1 of class 1."""
    data = FE.scale_minmax(pdata(spark, sf), NUMERIC)
    pipe, sel = L.selector_pipeline("logistic", 3)
    lr = pipe.getStages()[1]
    grid = (ParamGridBuilder().addGrid(sel.selectionThreshold, [3.0, 5.0, 7.0])
            .addGrid(lr.regParam, [0.0, 0.01]).build())
    folded = written(S.split_strat_kfold(L.assemble(data, NUMERIC, out="raw"), 3), "folds")
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid,
                        evaluator=MulticlassClassificationEvaluator(**F1_EVAL),
                        foldCol="fold", parallelism=4, seed=42)
    model = cv.fit(folded)
    rows = [("selector+logistic",
             str(sorted((p.name, v) for p, v in pm.items())), float(m)) for pm, m in zip(grid, model.avgMetrics)]
    return r(spark.createDataFrame(rows, "model string, params string, mean_f1 double"))


RANDOM_GRID = [{"regParam": rp, "elasticNetParam": en, "maxIter": it}
               for rp in (0.0, 0.003, 0.01, 0.03, 0.1) for en in (0.0, 0.5) for it in (50, 100)]


@register("random_search")
def q_random_search(spark, sf):
    """A seeded sample of six of twenty settings."""
    pick = L.md5_grid_sample(RANDOM_GRID, 6)
    data = FE.scale_minmax(pdata(spark, sf), NUMERIC)
    res, _ = cv_search(data, NUMERIC, "logistic", pick)
    return r(_search_rows(spark, [("logistic", res)]))


@register("best_model_pick")
def q_best_model_pick(spark, sf):
    """Best (model, params) over ALL searched pipelines (fixes the per-pipeline
    reset of the reference)."""
    data = FE.scale_minmax(pdata(spark, sf), NUMERIC)
    results = [(m, cv_search(data, NUMERIC, m, g)[0]) for m, g in SEARCH_GRID.items()]
    rows = _search_rows(spark, results)
    return r(rows.agg(F.max_by(F.struct("model", "params"), "mean_f1").alias("b"), F.max("mean_f1").alias("mean_f1"))
             .select("b.model", "b.params", "mean_f1"))


@register("nested_search")
def q_nested_search(spark, sf):
    """Outer 3-fold split, inner 3-fold grid search on the outer training part,
    outer-test F1/precision/recall of the inner winner.  The model of the best
    outer fold is kept as a bundle (``is_best``)."""
    from raremine.sources.bundle import save_bundle

    data = FE.scale_minmax(pdata(spark, sf), NUMERIC)
    outer = written(S.split_strat_kfold(data, 3).withColumnRenamed("fold", "outer"), "outer")
    rows, models = [], []
    for f in range(3):
        tr = outer.filter(F.col("outer") != f).drop("outer")
        te = outer.filter(F.col("outer") == f).drop("outer")
        res, model = cv_search(tr, NUMERIC, "logistic", NESTED_GRID)
        best = max(res, key=lambda t: t[1])
        pred = model.bestModel.transform(L.assemble(te, NUMERIC)).select("id", "label", "prediction")
        m = M.f1_prec_rec(pred).first()
        rows.append((f, str(sorted(best[0].items())), best[1], m["f1"], m["precision"], m["recall"]))
        models.append(model.bestModel)
    top = max(range(len(rows)), key=lambda i: (rows[i][3], -i))
    save_bundle(spark, models[top], data, ["label", *NUMERIC], name="nested")
    return r(spark.createDataFrame([(*row, i == top) for i, row in enumerate(rows)], "outer_fold int, params string, inner_f1 double,"
                                   " test_f1 double, test_precision double, test_recall double, is_best boolean"))


@register("tree_holdout_eval")
def q_tree_holdout_eval(spark, sf):
    """70/30 hold-out, boosted trees with early stopping: AUC (hard labels, as
    the reference), F1, precision, recall, rounds kept, and per feature its
    split count relative to the largest."""
    h = _holdout(spark, sf, 0.3)
    model = TR.fit_boosted(h.filter(~F.col("is_test")), NUMERIC, **BOOSTED)
    pred = (model.transform(L.assemble(h.filter("is_test"), NUMERIC))
            .select("id", "label", F.col("prediction").cast("double").alias("prediction")))
    auc = M.roc_auc(pred, "label", "prediction").first()["auc"]
    counts = TR.split_counts(TR.tree_nodes(model, spark), NUMERIC)
    importance = FE.relative_importance(counts, "importance").select(
        F.sort_array(F.collect_list(F.struct("feature", "importance", det_round("relative", 6).alias("relative")))).alias("importances"))
    scores = r(M.f1_prec_rec(pred).withColumn("auc", F.lit(auc).cast("double"))).withColumn("rounds", F.lit(model.getNumTrees))
    return scores.crossJoin(F.broadcast(importance))         # one row each


def boost_round_cv(data: DataFrame, features, k: int = 3, max_iter: int = 20, max_depth: int = 3, step: float = 0.05) -> DataFrame:
    """(round, train_auc, test_auc, train_loss, test_loss): means over k
    stratified folds after every boosting round.  Every fold is fitted once;
    scores per round are the running margins of its tree prefixes."""
    folded = written(S.split_strat_kfold(L.assemble(data, features), k), "folds")
    staged = None
    for f in range(k):
        model = TR.fit_boosted(folded.filter(F.col("fold") != f), features, max_iter=max_iter, max_depth=max_depth, step=step, validation_share=None)
        part = TR.staged_margins(folded.withColumn("part", F.when(F.col("fold") == f, "test").otherwise("train")),
                                 TR.tree_nodes(model, data.sparkSession))
        part = part.select(F.lit(f).alias("split"), "part", "label", F.posexplode("margins").alias("i", "score"))
        staged = part if staged is None else staged.unionByName(part)
    # scored once: the trees run in Python, and both measures read the scores
    staged = written(staged.select("split", "part", "label", (F.col("i") + 1).alias("round"), "score"), "margins")
    auc = M.roc_auc(staged, "label", "score", ["split", "part", "round"])
    y = F.col("label") * 2 - 1
    loss = staged.groupBy("split", "part", "round").agg(F.avg(2 * F.log1p(F.exp(-2 * y * F.col("score")))).alias("loss"))
    both = auc.join(loss, ["split", "part", "round"])
    return both.groupBy("round").agg(*[F.avg(F.when(F.col("part") == part, F.col(m))).alias(f"{part}_{m}")
                                       for m in ("auc", "loss") for part in ("train", "test")])


@register("boost_round_cv")
def q_boost_round_cv(spark, sf):
    """Mean train/test AUC and log-loss per boosting round over 3 folds, and the
    best round (largest mean test AUC, the first of equals)."""
    per = written(r(boost_round_cv(pdata(spark, sf), NUMERIC)), "rounds")
    best = per.agg(F.min_by("round", F.struct(-F.col("test_auc"), "round"))).first()[0]
    return per.withColumn("is_best", F.col("round") == F.lit(best))


@register("sink_model_bundle", with_ctes(O.PERSON_DATA) +
          " SELECT CAST(count(*) AS BIGINT) AS n_rows, '" + ",".join(["label", *NUMERIC]) + "' AS features FROM data")
def q_sink_model_bundle(spark, sf):
    """Classifier + dataset + ordered feature list written under the
    checkpoint folder; the result reads the bundle back (rows, feature list)."""
    from raremine.sources.bundle import load_bundle, save_bundle
    h = _holdout(spark, sf)
    est = L.make_estimator("gaussian_nb")
    model = est.fit(L.assemble(h.filter(~F.col("is_test")), NUMERIC))
    path = save_bundle(spark, model, pdata(spark, sf), ["label", *NUMERIC], name="gnb")
    _, data, feats = load_bundle(spark, path)
    return data.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(",".join(feats)).alias("features"))


@register("src_model_bundle", with_ctes(O.PERSON_CLEAN_SQL, *GNB_HOLDOUT_SQL) +
          " SELECT id, label, cls AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY jll DESC, cls)"
          " AS rr FROM sc) WHERE rr = 1")
def q_src_model_bundle(spark, sf):
    from raremine.sources.bundle import load_bundle, save_bundle
    h = _holdout(spark, sf)
    model = L.make_estimator("gaussian_nb").fit(L.assemble(h.filter(~F.col("is_test")), NUMERIC))
    path = save_bundle(spark, model, h, ["label", *NUMERIC], name="gnb_rt")
    clf, data, feats = load_bundle(spark, path)
    pred = clf.transform(L.assemble(data.filter("is_test"), feats[1:]))
    return pred.select("id", "label", F.col("prediction").cast("double"))


def learning_curve_sql(features=NUMERIC, k: int = 10, granularity: int = 10) -> str:
    g = granularity - 1
    stats = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in features)
    const = " + ".join(f"ln(2 * pi() * (g.v_{c} + t.eps))" for c in features)
    quad = " + ".join(f"pow(s.{c} - g.m_{c}, 2) / (g.v_{c} + t.eps)" for c in features)

    def score(src, out):
        return [f"{out}_s AS (SELECT s.fold, s.size, s.id, s.label, g.cls, ln(g.n / t.ntot) - 0.5 * ({const})"
                f" - 0.5 * ({quad}) AS jll FROM {src} s JOIN lc_g g ON g.fold = s.fold AND g.size = s.size"
                f" JOIN lc_t t ON t.fold = s.fold AND t.size = s.size)",
                f"{out} AS (SELECT fold, size, id, label, cls AS prediction FROM (SELECT *, row_number() OVER"
                f" (PARTITION BY fold, size, id ORDER BY jll DESC, cls) AS rr FROM {out}_s) WHERE rr = 1)",
                f"{out}_f AS (SELECT fold, size, coalesce(2 * count(*) FILTER (WHERE prediction = 1 AND label = 1) /"
                f" nullif(2 * count(*) FILTER (WHERE prediction = 1 AND label = 1) + count(*) FILTER"
                f" (WHERE prediction = 1 AND label = 0) + count(*) FILTER (WHERE prediction = 0 AND label = 1), 0), 0)"
                f" AS f1 FROM {out} GROUP BY fold, size)"]

    ctes = [O.PERSON_CLEAN_SQL, O.person_data_cte()] + O.strat_split_ctes(k) + [
        "lc_tr AS (SELECT f.fold, d.* FROM data d CROSS JOIN folds f WHERE NOT EXISTS"
        " (SELECT 1 FROM test t WHERE t.fold = f.fold AND t.id = d.id))",
        "lc_rk AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY md5(concat_ws('|', '42', 'train',"
        " CAST(fold AS VARCHAR), id)), id) AS rn FROM lc_tr)",
        "lc_m AS (SELECT CAST(count(*) AS DOUBLE) * CAST(0.9 AS DOUBLE) AS m FROM data)",
        f"lc_sz AS (SELECT CAST(CASE WHEN i = {g} THEN trunc(m) ELSE trunc(i * ((m - 20) / {g}) + 20) END AS BIGINT)"
        f" AS size FROM range({granularity}) r(i), lc_m)",
        "lc_sub AS (SELECT r.*, s.size FROM lc_rk r JOIN lc_sz s ON r.rn <= s.size)",
        f"lc_g AS (SELECT fold, size, label AS cls, count(*) AS n, {stats} FROM lc_sub GROUP BY fold, size, label)",
        "lc_t AS (SELECT fold, size, count(*) AS ntot, 1e-9 * greatest(" +
        ", ".join(f"var_pop({c})" for c in features) + ") AS eps FROM lc_sub GROUP BY fold, size)",
        "lc_val AS (SELECT t.*, s.size FROM test t CROSS JOIN lc_sz s)",
    ] + score("lc_sub", "lc_ptr") + score("lc_val", "lc_pva")
    return with_ctes(*ctes) + (" SELECT a.size, round(avg(a.f1), 6) AS train_mean, round(stddev_pop(a.f1), 6) AS train_std,"
                               " round(avg(b.f1), 6) AS val_mean, round(stddev_pop(b.f1), 6) AS val_std"
                               " FROM lc_ptr_f a JOIN lc_pva_f b ON a.fold = b.fold AND a.size = b.size GROUP BY a.size")


@register("learning_curve", learning_curve_sql())
def q_learning_curve(spark, sf):
    """GNB learning curve: 10 sizes x 10 stratified shuffle splits, all
    (split, size) models fitted in one aggregate."""
    from raremine.plans.evaluate import learning_curve_gnb
    return r(learning_curve_gnb(pdata(spark, sf), NUMERIC, k=10, granularity=10))


@register("learning_curve_pca")
def q_learning_curve_pca(spark, sf):
    """The learning curve with scaling and PCA fitted on the training rows of
    every split (axes that hold 96 % of the variance)."""
    from raremine.plans.evaluate import learning_curve_gnb
    return r(learning_curve_gnb(pdata(spark, sf), NUMERIC, k=10, granularity=10, scale=True, center=True, pca=0.96))


# -------------------------------------------- the reference's final setup --

SMOTE_DATA_SQL = SMOTE_SQL + [
    "data AS (SELECT id, CAST(poi AS DOUBLE) AS label, " + ", ".join(NUMERIC) + " FROM base UNION ALL"
    " SELECT concat_ws('|', 'smote', qid, rid, CAST(copy AS VARCHAR)) AS id, CAST(1 AS DOUBLE) AS label, " +
    ", ".join(f"x.{c} + u.u * (n.{c} - x.{c}) AS {c}" for c in NUMERIC) +
    " FROM u JOIN base x ON x.id = u.qid JOIN base n ON n.id = u.rid)",
]


@register("eval_smote_gnb", with_ctes(TRAIN_SQL, O.MINMAX_SQL, *SMOTE_DATA_SQL, *O.strat_split_ctes(1000),
                                      *O.gnb_fold_pred_ctes(NUMERIC)) + O.counts_metrics_select("pred"))
def q_eval_smote_gnb(spark, sf):
    """The reference's evaluated setup: min-max scaling, borderline SMOTE on
    the whole table (scope 'global', so synthetic rows reach the test folds,
    as in the reference), then the 1000-split Gaussian NB evaluator."""
    from raremine.plans.evaluate import eval_shuffle_cv_gnb

    res = NB.smote_resample(scaled_train(spark, sf), NUMERIC, TARGET, "id")
    data = res.select("id", F.col(TARGET).cast("double").alias("label"), *NUMERIC)
    return r(eval_shuffle_cv_gnb(data, NUMERIC, folds=1000))


def smote_train_sql(features=NUMERIC, k: int = 5) -> str:
    f = list(features)
    d2 = " + ".join(f"pow(a.{c} - b.{c}, 2)" for c in f)
    stats = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in f)
    const = " + ".join(f"ln(2 * pi() * (m.v_{c} + t.eps))" for c in f)
    quad = " + ".join(f"pow(s.{c} - m.m_{c}, 2) / (m.v_{c} + t.eps)" for c in f)
    ctes = [TRAIN_SQL, O.MINMAX_SQL, O.kfold_sql("scaled", "poi", k, "kf"),
            f"gb AS (SELECT f.g, k.id, k.poi, {', '.join('k.' + c for c in f)} FROM kf k CROSS JOIN range({k}) f(g)"
            " WHERE k.kfold <> f.g)",
            f"gte AS (SELECT f.g, k.id, CAST(k.poi AS DOUBLE) AS label, {', '.join('k.' + c for c in f)}"
            f" FROM kf k CROSS JOIN range({k}) f(g) WHERE k.kfold = f.g)",
            "gmn AS (SELECT * FROM gb WHERE poi = 1)",
            f"gd AS (SELECT a.g, a.id AS qid, b.id AS rid, b.poi AS rl, {d2} AS d2 FROM gmn a JOIN gb b"
            " ON a.g = b.g AND a.id <> b.id)",
            "gnn AS (SELECT g, qid, rl FROM (SELECT *, row_number() OVER (PARTITION BY g, qid ORDER BY d2, rid) AS rk"
            " FROM gd) WHERE rk <= 10)",
            "gdanger AS (SELECT g, qid FROM gnn GROUP BY g, qid HAVING count(*) FILTER (WHERE rl <> 1) >= 5"
            " AND count(*) FILTER (WHERE rl <> 1) < 10)",
            f"gpr AS (SELECT a.g, a.id AS qid, b.id AS rid, {d2} AS d2 FROM gmn a JOIN gmn b ON a.g = b.g AND a.id <> b.id"
            " JOIN gdanger dz ON dz.g = a.g AND dz.qid = a.id)",
            "gpairs AS (SELECT g, qid, rid FROM (SELECT *, row_number() OVER (PARTITION BY g, qid ORDER BY d2, rid) AS rk"
            " FROM gpr) WHERE rk <= 5)",
            "gcnt AS (SELECT g, count(*) FILTER (WHERE poi <> 1) - count(*) FILTER (WHERE poi = 1) AS n_new FROM gb GROUP BY g)",
            "gnp AS (SELECT g, count(*) AS np FROM gpairs GROUP BY g)",
            "gprk AS (SELECT p.*, row_number() OVER (PARTITION BY g ORDER BY md5(concat_ws('|', '42', CAST(g AS VARCHAR),"
            " qid, rid)), qid, rid) AS prn FROM gpairs p)",
            "gch AS (SELECT r.g, r.qid, r.rid, unnest(range(CAST(c.n_new // n.np + CASE WHEN r.prn <= c.n_new % n.np"
            " THEN 1 ELSE 0 END AS BIGINT))) AS copy FROM gprk r JOIN gcnt c ON c.g = r.g JOIN gnp n ON n.g = r.g"
            " WHERE c.n_new > 0)",
            "gu AS (SELECT gch.*, CAST(('0x' || substr(md5(concat_ws('|', '42', CAST(g AS VARCHAR), qid, rid,"
            " CAST(copy AS VARCHAR))), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS u FROM gch)",
            "gfit AS (SELECT g, id, CAST(poi AS DOUBLE) AS label, " + ", ".join(f) + " FROM gb UNION ALL"
            " SELECT u.g, 'syn', CAST(1 AS DOUBLE), " + ", ".join(f"x.{c} + u.u * (n.{c} - x.{c})" for c in f) +
            " FROM gu u JOIN gb x ON x.g = u.g AND x.id = u.qid JOIN gb n ON n.g = u.g AND n.id = u.rid)",
            f"gm AS (SELECT g, label AS cls, count(*) AS n, {stats} FROM gfit GROUP BY g, label)",
            "gt AS (SELECT g, count(*) AS ntot, 1e-9 * greatest(" + ", ".join(f"var_pop({c})" for c in f) +
            ") AS eps FROM gfit GROUP BY g)",
            f"gsc AS (SELECT s.g, s.id, s.label, m.cls, ln(m.n / t.ntot) - 0.5 * ({const}) - 0.5 * ({quad}) AS jll"
            " FROM gte s JOIN gm m ON m.g = s.g JOIN gt t ON t.g = s.g)",
            "pred AS (SELECT g, id, label, cls AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY g, id"
            " ORDER BY jll DESC, cls) AS rr FROM gsc) WHERE rr = 1)"]
    return with_ctes(*ctes) + O.counts_metrics_select("pred")


def full_chain(people: DataFrame, features, scope: str = "global", folds: int = 1000, share: float = 0.96,
               threshold: float = 0.93) -> DataFrame:
    """The reference's whole chain on a train frame: rows with four or more
    outlying features go, min-max scaling, pairwise interactions, columns that
    are not finite go, columns correlated with an earlier one go, z-scores,
    borderline SMOTE, PCA on the fewest axes with ``share`` of the variance, and
    the Gaussian NB evaluator.

    ``scope`` 'global' resamples the whole table before the splits, as the
    reference does; 'train' resamples the training rows of each fold of a
    5-fold split, and PCA sees original rows only."""
    from raremine.operators import clean as C
    from raremine.operators import stats as ST
    from raremine.plans.evaluate import eval_shuffle_cv_gnb, eval_smote_train_gnb
    from raremine.session import cut_lineage

    outliers = ST.outlier_rows_iqr(people, features, 2.0, 4).select("id")
    scaled = FE.scale_minmax(people.join(outliers, "id", "left_anti"), features)
    inter = cut_lineage(FE.interaction_features(scaled, features, keep=("id", *features, TARGET)))
    names = C.drop_nonfinite_columns(inter, [*features, TARGET, *FE.interaction_names(features)])
    dropped = set(ST.drop_correlated(ST.spearman_matrix(inter, names), names, TARGET, threshold))
    kept = [n for n in names if n not in dropped and n != TARGET]
    z = [f"z{i}" for i in range(len(kept))]
    ready = FE.scale_standard(inter.select("id", TARGET, *[F.col(f"`{n}`").alias(c) for n, c in zip(kept, z)]), z)
    rows = cut_lineage(NB.smote_resample(ready, z, TARGET, "id") if scope == "global" else ready)
    model, means, k, _ = L.pca_fit(rows, z, share)
    scores = L.pca_transform(rows, z, model, means, k, keep=["id", TARGET])
    axes = [c for c in scores.columns if c not in ("id", TARGET)]
    data = cut_lineage(scores.select("id", F.col(TARGET).cast("double").alias("label"), *axes))
    return eval_shuffle_cv_gnb(data, axes, folds=folds) if scope == "global" else eval_smote_train_gnb(data, axes, k=5)


@register("eval_full_chain")
def q_eval_full_chain(spark, sf):
    return r(full_chain(train_frame(spark, sf), NUMERIC))


@register("eval_full_chain_train")
def q_eval_full_chain_train(spark, sf):
    return r(full_chain(train_frame(spark, sf), NUMERIC, scope="train"))


@register("eval_smote_train_gnb", smote_train_sql())
def q_eval_smote_train_gnb(spark, sf):
    """Leak-free counterpart of eval_smote_gnb: 5-fold stratified CV with
    borderline SMOTE fitted on each fold's training rows only."""
    from raremine.plans.evaluate import eval_smote_train_gnb

    data = scaled_train(spark, sf).select("id", F.col(TARGET).alias("label"), *NUMERIC)
    return r(eval_smote_train_gnb(data, NUMERIC, k=5))
