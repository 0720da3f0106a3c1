"""Hand-made frames with planted edge cases, and invariants of the operators."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from raremine.operators import clean as C
from raremine.operators import features as FE
from raremine.operators import metrics as M
from raremine.operators import models as MO
from raremine.operators import neighbors as NB
from raremine.operators import sampling as S
from raremine.operators import stats as ST


@pytest.fixture(scope="module")
def people(spark):
    rows = [
        ("A", "True", "a@x.com", "10", "NaN", "1"),
        ("B", "False", "NaN", "20", "5", "0"),
        ("C", "False", "c@x.com", "NaN", "NaN", "0"),
        ("D", "True", "d@x.com", "40", "7", "3"),
        ("TOTAL", "False", "NaN", "70", "12", "4"),
    ]
    return spark.createDataFrame(rows, "id string, poi string, email_address string, a string, b string, c string")


def test_clean_records_sentinels(people):
    out = {r["id"]: r for r in C.clean_records(people, "poi").collect()}
    assert out["A"]["poi"] == 1 and out["B"]["poi"] == 0
    assert out["B"]["email_address"] is None
    assert out["A"]["b"] is None and not (isinstance(out["A"]["b"], float) and math.isnan(out["A"]["b"]))
    assert out["D"]["a"] == 40.0


def test_feature_format_zero_rules(spark):
    df = spark.createDataFrame([("x", 1.0, 0.0, 0.0), ("y", 0.0, 0.0, 2.0), ("z", 0.0, None, 0.0)],
                               "id string, poi double, f double, g double")
    all_zero = C.feature_format(df, ["poi", "f", "g"])
    assert sorted(r.id for r in all_zero.collect()) == ["y"]          # poi exempt, null -> 0
    keep_nan = C.feature_format(df, ["poi", "f", "g"], remove_nan=False)
    assert sorted(r.id for r in keep_nan.collect()) == ["y", "z"]     # null counts as non-zero
    any_zero = C.feature_format(df, ["poi", "f", "g"], remove_any_zeroes=True)
    assert any_zero.count() == 0
    with pytest.raises(ValueError):
        C.feature_format(df, ["poi", "missing"])


def test_encode_label_byte_order(spark):
    df = spark.createDataFrame([("1", "b"), ("2", None), ("3", "a"), ("4", "b")], "id string, e string")
    codes = {r.id: r.code for r in C.encode_label(df, "e", "code").collect()}
    assert codes == {"2": 0, "3": 1, "1": 2, "4": 2}


def test_global_row_number_matches_sort(spark):
    df = spark.range(0, 1000).select(F.md5(F.col("id").cast("string")).alias("h"))
    ranked = C.global_row_number(df, ["h"], "rn", partitions=7).toPandas().sort_values("rn")
    assert list(ranked["rn"]) == list(range(1, 1001))
    assert list(ranked["h"]) == sorted(ranked["h"])


def test_minmax_constant_column(spark):
    df = spark.createDataFrame([("a", 3.0, 1.0), ("b", 3.0, 5.0)], "id string, k double, v double")
    out = {r.id: r for r in FE.scale_minmax(df, ["k", "v"]).collect()}
    assert out["a"]["k"] == pytest.approx(0.0001) and out["b"]["k"] == pytest.approx(0.0001)
    assert out["a"]["v"] == pytest.approx(0.0001) and out["b"]["v"] == pytest.approx(1.0)


def test_standard_scaler_population_std(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 2.0)], "id string, v double")
    out = {r.id: r.v for r in FE.scale_standard(df, ["v"]).collect()}
    assert out["a"] == pytest.approx(-1 / math.sqrt(2 / 3))


def test_interaction_count(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 0.0)], "id string, x double, y double, z double")
    inter = FE.interaction_features(df, ["x", "y", "z"])
    assert len(inter.columns) - 1 == 3 * 9 - 2 * 3
    r = inter.first()
    assert r["x/z"] is None and r["x*y"] == 2.0 and r["y-x"] == 1.0


def test_stratified_sizes_largest_remainder():
    # reference evaluator: 146 rows -> 15 test rows, 252 rows -> 26 test rows per split
    assert sum(S.stratified_test_sizes({0: 128, 1: 18}, 0.1).values()) == 15
    assert sum(S.stratified_test_sizes({0: 126, 1: 126}, 0.1).values()) == 26
    assert S.stratified_test_sizes({0: 90, 1: 10}, 0.1) == {0: 9, 1: 1}


def _frame(spark, n=200, pos_every=7):
    rows = [(f"r{i:04d}", 1.0 if i % pos_every == 0 else 0.0, float(i % 13), float((i * 7) % 11)) for i in range(n)]
    return spark.createDataFrame(rows, "id string, label double, f1 double, f2 double")


def test_strat_shuffle_invariants(spark):
    df = _frame(spark)
    counts = S.class_counts(df)
    sizes = S.stratified_test_sizes(counts, 0.1)
    test = S.split_strat_shuffle(df, 20).toPandas()
    per = test.groupby(["fold", "label"]).size()
    for (fold, lab), n in per.items():
        assert n == sizes[lab]
    # same answer on other partitionings
    plain = S.split_strat_shuffle(df.repartition(3), 20).toPandas()
    other = S.split_strat_shuffle(df.repartition(5), 20).toPandas()
    key = lambda d: sorted(zip(d["fold"], d["id"]))
    assert key(test) == key(plain) == key(other)


def test_kfold_each_row_once(spark):
    df = _frame(spark)
    folds = S.split_strat_kfold(df, 5).toPandas()
    assert len(folds) == 200 and folds["id"].is_unique
    per = folds.groupby(["label", "fold"]).size().unstack()
    assert (per.max(axis=1) - per.min(axis=1)).max() <= 1


def test_holdout_exact_size(spark):
    df = _frame(spark, 101)
    h = S.split_holdout(df, 0.1)
    assert h.filter("is_test").count() == 11


def test_gnb_fold_statistics_equal_refits(spark):
    """Fold statistics by subtraction == refitting on every training set."""
    df = _frame(spark)
    pred = MO.gnb_fold_predictions(df, ["f1", "f2"], 4).toPandas()
    test = S.split_strat_shuffle(df, 4, keep=["f1", "f2"])
    for f in range(4):
        te = test.filter(F.col("fold") == f)
        tr = df.join(te.select("id"), "id", "left_anti")
        model = MO.gnb_fit(tr, ["f1", "f2"])
        direct = {r.id: r.prediction for r in MO.gnb_predict(te, model).collect()}
        got = {r.id: r.prediction for r in pred[pred["fold"] == f].itertuples()}
        assert {k: float(v) for k, v in direct.items()} == {k: float(v) for k, v in got.items()}


def test_confusion_metrics_zero_denominators(spark):
    pred = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.0)], "id int, label double, prediction double")
    m = M.confusion_metrics(M.confusion_counts(pred, fold=None)).first()
    assert m["tn"] == 2 and m["precision"] is None and m["recall"] is None and m["f1"] is None
    assert m["accuracy"] == 1.0


def test_confusion_counts_stop_on_invalid(spark):
    pred = spark.createDataFrame([(0, "a", 1.0, 1.0), (0, "b", 1.0, 2.0), (0, "c", 0.0, 0.0),
                                  (1, "a", 0.0, 0.0)], "fold int, id string, label double, prediction double")
    c = M.confusion_counts(pred).first()
    assert (c["total"], c["tp"], c["tn"]) == (2, 1, 1)


def test_reference_metric_row():
    # check row of the reference evaluator: 12279 / 8 / 721 / 12992
    tp, fp, fn, tn = 12279, 8, 721, 12992
    p, r = tp / (tp + fp), tp / (tp + fn)
    assert round(2 * tp / (2 * tp + fp + fn), 5) == 0.97117
    assert round(5 * p * r / (4 * p + r), 5) == 0.95501


def test_average_ranks_ties(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0), ("d", 5.0)], "id string, v double")
    long = ST.to_long(df, ["v"])
    ranks = {r.id: r["rank"] for r in ST.average_ranks(long).collect()}
    assert ranks == {"a": 1.0, "b": 2.5, "c": 2.5, "d": 4.0}


def test_outliers_missing_counts_as_outside(spark):
    rows = [(f"p{i}", float(i), float(i)) for i in range(20)] + [("big", 1000.0, None)]
    df = spark.createDataFrame(rows, "id string, a double, b double")
    out = ST.outlier_rows_iqr(df, ["a", "b"], 2.0, 1).collect()
    assert [(r.id, r.n_flags) for r in out] == [("big", 2)]


def test_drop_correlated_keeps_target():
    mat = {("y", "a"): 0.99, ("a", "y"): 0.99, ("a", "b"): 0.95, ("b", "a"): 0.95,
           ("y", "b"): 0.1, ("b", "y"): 0.1}
    assert ST.drop_correlated(mat, ["y", "a", "b"], "y", 0.93) == ["b"]


def test_smote_no_danger_rows(spark):
    # minority far from majority: every minority neighbourhood is pure -> nothing to create
    rows = [(f"n{i}", 0, float(i), 0.0) for i in range(30)] + [(f"p{i}", 1, 1000.0 + i, 0.0) for i in range(12)]
    df = spark.createDataFrame(rows, "id string, label int, x double, y double")
    assert NB.smote_borderline(df, ["x", "y"], "label").count() == 0


def test_smote_points_on_segments(spark):
    rows = [(f"n{i:02d}", 0, float(i % 6), float(i // 6)) for i in range(36)] + \
           [(f"p{i}", 1, 2.5 + 0.1 * i, 2.5) for i in range(6)]
    df = spark.createDataFrame(rows, "id string, label int, x double, y double")
    syn = NB.smote_borderline(df, ["x", "y"], "label").toPandas()
    assert len(syn) == 30
    src = {r.id: (r.x, r.y) for r in df.collect()}
    for r in syn.itertuples():
        (x0, y0), (x1, y1) = src[r.source], src[r.neighbour]
        t = (r.x - x0) / (x1 - x0) if x1 != x0 else 0.0
        assert -1e-9 <= t <= 1 + 1e-9
        assert r.y == pytest.approx(y0 + t * (y1 - y0))


def test_knn_join_matches_brute_force(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    pts = rng.normal(size=(120, 3))
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(pts)], "id long, v array<double>")
    got = NB.knn_join(df, df, 4, block_rows=16).toPandas()
    for i in (0, 17, 119):
        d = ((pts - pts[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        want = list(np.lexsort((np.arange(120), d))[:4])
        assert list(got[got.qid == i].sort_values("rank").rid) == want


def test_anova_matches_formula(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (1, 4.0), (1, 6.0)], "label int, x double")
    f = ST.anova_f(df, ["x"], "label").first()["f"]
    # groups (1,2) and (4,6): SSB = 2*(1.5-3.25)^2 + 2*(5-3.25)^2, SSW = 0.5 + 2
    assert f == pytest.approx((2 * 1.75 ** 2 * 2 / 1) / (2.5 / 2))


def test_select_percentile_ties(spark):
    df = spark.createDataFrame([(f"t{i}", float(v)) for i, v in enumerate([1, 2, 3, 3, 3, 3, 3, 3, 3, 3])],
                               "feature string, f double")
    out = ST.select_percentile(df, 20.0).collect()
    assert len(out) == 2 and all(r.f == 3.0 for r in out)


def test_grouped_smote_balances_each_group(spark):
    rows = []
    for g in range(3):
        rows += [(g, f"n{g}_{i:02d}", 0, float(i % 6), float(i // 6)) for i in range(36 + g)]
        rows += [(g, f"p{g}_{i}", 1, 2.5 + 0.1 * i, 2.5) for i in range(6)]
    df = spark.createDataFrame(rows, "g int, id string, label int, x double, y double")
    syn = NB.smote_borderline(df, ["x", "y"], "label", group="g").toPandas()
    per = syn.groupby("g").size().to_dict()
    assert per == {0: 30, 1: 31, 2: 32}
    # neighbours never cross groups
    src = {(r.g, r.id) for r in df.collect()}
    assert all((r.g, r.source) in src and (r.g, r.neighbour) in src for r in syn.itertuples())


def test_grouped_knn_stays_in_group(spark):
    rows = [(g, i, [float(i), float(g)]) for g in range(2) for i in range(30)]
    df = spark.createDataFrame([(g, g * 100 + i, v) for g, i, v in rows], "g int, id long, v array<double>")
    nn = NB.knn_join(df, df, 3, group="g", block_rows=8).toPandas()
    assert len(nn) == 60 * 3
    assert all((r.qid // 100) == (r.rid // 100) == r.g for r in nn.itertuples())


def test_vif_filter_drops_collinear(spark):
    rows = [(float(i), float(2 * i + (i % 3)), float((i * 7) % 5)) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    kept, v = ST.vif_filter(df, ["a", "b", "c"], 10.0)
    assert kept == ["c"] and v["a"] > 10 and v["b"] > 10
    # p = 2: VIF = 1 / (1 - r^2)
    r = df.stat.corr("a", "c")
    assert ST.vif(df, ["a", "c"])["a"] == pytest.approx(1 / (1 - r * r))


def test_salted_join_hot_key(spark):
    from raremine.operators.joins import hot_keys, salted_join
    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(3000)], "id int, k string")
    small = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 3000, 3)], "k string, v int")
    assert [r.k for r in hot_keys(big, ["k"]).collect()] == ["hot"]
    got = salted_join(big, small, ["k"], "left").toPandas().sort_values("id")
    want = big.join(small, "k", "left").toPandas().sort_values("id")
    assert list(got["id"]) == list(want["id"]) and list(got["v"]) == list(want["v"])


def test_holdout_hash_threshold_is_deterministic(spark):
    df = _frame(spark, 2000)
    a = S.split_holdout(df, 0.1, exact=False)
    b = S.split_holdout(df.repartition(7), 0.1, exact=False)
    ta = sorted(r.id for r in a.filter("is_test").collect())
    tb = sorted(r.id for r in b.filter("is_test").collect())
    assert ta == tb and 140 <= len(ta) <= 260          # about 10 %, no global sort


def test_feature_format_preset_key_order(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("b", 0.0, 2.0), ("c", 1.0, 3.0)], "id string, poi double, f double")
    order = spark.createDataFrame([("c", 0), ("a", 1)], "id string, ord int")
    out = C.feature_format(df, ["poi", "f"], sort_keys="preset", key_order=order).collect()
    assert [r.id for r in out] == ["c", "a"]            # inner join on the preset keys, in their order


def test_strat_shuffle_is_the_smallest_keys_of_each_class(spark):
    import hashlib

    df = _frame(spark)
    rows = [(r.id, r.label) for r in df.collect()]
    sizes = S.stratified_test_sizes(S.class_counts(df), 0.1)
    got = {(r.fold, r.id) for r in S.split_strat_shuffle(df, 7, seed=5).collect()}
    want = set()
    for fold in range(7):
        for label, n in sizes.items():
            keys = sorted((hashlib.md5(f"5|{fold}|{i}".encode()).hexdigest(), i) for i, lab in rows if lab == label)
            want |= {(fold, i) for _, i in keys[:n]}
    assert got == want


def test_pearson_has_one_null_rule_for_any_width(spark):
    rows = [[float((i * (j + 3)) % 17 + i * j * 0.01) for j in range(45)] for i in range(60)]
    rows[7][0] = None
    names = [f"c{j}" for j in range(45)]
    df = spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{n} double" for n in names))
    wide, small = ST.pearson_matrix(df, names), ST.pearson_matrix(df, names[:10])
    for k, v in small.items():
        assert (v is None) == (wide[k] is None) and (v is None or abs(v - wide[k]) < 1e-9)
    assert wide[("c0", "c1")] is not None


def test_interactions_keep_the_pairwise_order():
    assert FE.interaction_names(["a", "b"]) == ["a*a", "a*b", "a+b", "a/b", "a-b", "b/a", "b-a", "b*b"]


def test_knn_refuses_missing_coordinates(spark):
    df = spark.createDataFrame([(1, [0.0, None]), (2, [1.0, 1.0]), (3, [2.0, 1.0])], "id long, v array<double>")
    with pytest.raises(Exception, match="finite coordinates"):
        NB.knn_join(df, df, 1).collect()


def test_select_percentile_counts_undefined_scores(spark):
    df = spark.createDataFrame([(f"f{i}", float(i) if i > 4 else None) for i in range(10)], "feature string, f double")
    assert sorted(r.feature for r in ST.select_percentile(df, 30.0).collect()) == ["f7", "f8", "f9"]


def test_split_strat_shuffle_never_broadcasts_exploded_rows(spark):
    """1000 folds: the build side of every broadcast join is the table of
    thresholds, whatever Spark estimates for the exploded rows."""
    df = spark.range(300).select(F.col("id").cast("string").alias("id"), (F.col("id") % 7 == 0).cast("double").alias("label"))
    test = S.split_strat_shuffle(df, 1000)
    assert test.count() == 1000 * 30
    plan = test._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "explode" not in plan        # a filter of written rows
    joins = [line for line in plan.split("\n") if "Join Inner" in line]
    assert len(joins) == 1 and "rightHint=(strategy=broadcast)" in joins[0]


def test_split_with_thresholds_outside_the_band(spark, monkeypatch):
    """A band that holds no threshold: everything is ranked, with the same result."""
    df = spark.range(200).select(F.col("id").cast("string").alias("id"), (F.col("id") % 5 == 0).cast("double").alias("label"))
    want = {(r.fold, r.id) for r in S.split_strat_shuffle(df, 9).collect()}
    held = {r.id for r in S.split_holdout(df, 0.3).filter("is_test").collect()}
    monkeypatch.setattr(S, "digest_band", lambda size, count: ("0", "0000000000001"))
    assert {(r.fold, r.id) for r in S.split_strat_shuffle(df, 9).collect()} == want and len(want) == 9 * 20
    assert {r.id for r in S.split_holdout(df, 0.3).filter("is_test").collect()} == held and len(held) == 60


def test_correlation_of_a_constant_column_is_undefined(spark):
    df = spark.createDataFrame([(f"i{i}", float(i), 2.0, float(i * i) if i != 3 else None) for i in range(6)],
                               "id string, a double, b double, c double")
    m = ST.pearson_matrix(df, ["a", "b", "c"])
    assert m[("a", "b")] is None and m[("b", "c")] is None
    rows = [(i, i * i) for i in range(6) if i != 3]
    mx, my = sum(x for x, _ in rows) / 5, sum(y for _, y in rows) / 5
    r = sum((x - mx) * (y - my) for x, y in rows) / math.sqrt(sum((x - mx) ** 2 for x, _ in rows) * sum((y - my) ** 2 for _, y in rows))
    assert abs(m[("a", "c")] - r) < 1e-12


def test_interactions_of_many_features_as_arrays(spark):
    """p = 200: 119,600 interactions in a plan as small as that for p = 2."""
    p = 200
    rows = [(i, [float((i * 7 + j * 3) % 11 - 4) for j in range(p)]) for i in range(3)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    out = FE.interaction_array(df, "v")
    got = {r.id: r.interactions for r in out.collect()}
    for i, v in rows:
        want = []
        for a in range(p):
            for b in range(p):
                want += [v[a] * v[b]] * (a <= b) + [v[a] + v[b]] * (a < b)
                if a != b:
                    want += [v[a] / v[b] if v[b] else None, v[a] - v[b]]
        assert len(want) == 3 * p * p - 2 * p and got[i] == want
    small = FE.interaction_array(spark.createDataFrame([(1, [1.0, 2.0])], "id long, v array<double>"), "v")
    size = lambda d: len(d._jdf.queryExecution().optimizedPlan().toString())
    assert size(out) <= size(small) + 200


def test_array_form_equals_the_columns(spark):
    names = ["a", "b", "c"]
    df = spark.createDataFrame([(1, 0.0, 2.0, -1.0), (2, 3.0, 2.0, 0.5), (3, -2.0, 2.0, 8.0)], "id long, a double, b double, c double")
    vec = df.select("id", F.array(*names).alias("v"))
    wide = FE.interaction_features(df, names).orderBy("id").collect()
    long = FE.interaction_array(vec, "v").orderBy("id").collect()
    order = FE.interaction_names(names)
    assert [[r[n] for n in order] for r in wide] == [r.interactions for r in long]
    inter = FE.interaction_array(vec, "v").select("id", F.col("interactions").alias("v"))
    finite = FE.finite_positions(inter, "v")
    assert [order[j] for j in finite] == C.drop_nonfinite_columns(FE.interaction_features(df, names), order)
    kept = FE.take_positions(inter, "v", finite).orderBy("id").collect()
    assert all(len(r.v) == len(finite) and None not in r.v for r in kept)
    scaled = FE.scale_minmax(df, names).orderBy("id").collect()
    assert [[r[n] for n in names] for r in scaled] == [r.v for r in FE.scale_array(vec, "v").orderBy("id").collect()]


def test_spearman_matrix_ranks_in_bins(spark, monkeypatch):
    """Ranks cut into small bins of values, with ties, nulls, a constant column
    and a key that repeats, equal those of whole columns."""
    monkeypatch.setattr(ST, "BIN_VALUES", 40)
    monkeypatch.setattr(ST, "CHUNK_NUMBERS", 150)
    monkeypatch.setattr(ST, "SAMPLE_NUMBERS", 400)
    rng = np.random.default_rng(3)
    x = rng.normal(size=300)
    pdf = pd.DataFrame({"id": [f"k{i}" for i in range(300)], "a": x, "b": np.round(x + rng.normal(size=300)), "flat": 2.0,
                        "c": np.where(rng.random(300) < 0.5, 0.0, rng.normal(size=300) - x)})
    rows = [(*r[:4], None if i % 11 == 0 else r[4]) for i, r in enumerate(pdf.itertuples(index=False, name=None))]
    cols = ["a", "b", "flat", "c"]
    df = spark.createDataFrame(rows, "id string, a double, b double, flat double, c double").repartition(5)
    got = ST.spearman_matrix(df, cols)
    ranks = pd.DataFrame([r[1:] for r in rows], columns=cols).rank()
    for p in cols:
        for q in cols:
            if p == q:
                assert got[p, q] == 1.0
            elif "flat" in (p, q):
                assert got[p, q] is None
            else:
                assert abs(got[p, q] - ranks[p].corr(ranks[q])) < 1e-12
    twice = df.unionByName(df.filter("id < 'k2'"))
    ranks = pd.DataFrame([r[1:] for r in rows + [r for r in rows if r[0] < "k2"]], columns=cols).rank().iloc[:300]
    assert abs(ST.spearman_matrix(twice, cols)["a", "b"] - ranks["a"].corr(ranks["b"])) < 1e-12


def test_split_table_keeps_digests_of_the_band_only(spark, monkeypatch):
    from raremine import session

    plain, seen = session.written, {}
    monkeypatch.setattr(session, "written", lambda df, name: seen.setdefault(name, plain(df, name)))
    df = spark.range(4000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 5 == 0).cast("double").alias("label"))
    assert S.split_strat_shuffle(df, 3, 0.5).count() == 3 * 2000
    near = seen["split"]
    assert near.filter("_h IS NULL").count() > 0.6 * near.count()


def test_fits_read_written_folds(spark, monkeypatch):
    """What the fits of a comparison and of a search read is a plain scan: no
    pass of an optimizer repeats the split's joins and sorts."""
    from raremine.plans import catalog_models as CM

    df = spark.range(120).select(F.col("id").cast("string").alias("id"), (F.col("id") % 4 == 0).cast("double").alias("label"),
                                 F.rand(1).alias("x"))
    frames = CM._fold_frames(df, 2)
    assert [(tr.count(), te.count()) for _, tr, te in frames] == [(108, 12)] * 2

    class Search:
        avgMetrics = [0.5]

        def __init__(self, **params):
            pass

        def fit(self, folded):
            self.read = folded
            return self
    monkeypatch.setattr(CM, "CrossValidator", Search)
    _, search = CM.cv_search(df, ["x"], "logistic", [{"regParam": 0.0}], 3)
    assert sorted(r["count"] for r in search.read.groupBy("fold").count().collect()) == [40, 40, 40]
    for part in [search.read, *[f for fold in frames for f in fold[1:]]]:
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Sort" not in plan and "Aggregate" not in plan


def test_fold_digests_are_md5_of_any_text():
    import hashlib

    from raremine.functions.digest import first_digits, fold_digests, hex_digests

    keys = ["a", "", "é" * 30, "x" * 46, "x" * 47, "x" * 48, "x" * 55, "y" * 200, None, "Customer#000000001"]
    seen = 0
    for fold, row, words in fold_digests(42, range(120), keys):
        for f, r, h, d in zip(fold, row, hex_digests(words), first_digits(words)):
            text = f"42|{f}" + ("" if keys[r] is None else f"|{keys[r]}")
            assert hashlib.md5(text.encode()).hexdigest() == h.decode() and int(h[:13], 16) == d
            seen += 1
    assert seen == 120 * len(keys)


def test_fold_predictions_keep_one_row_per_row(spark, monkeypatch):
    """The table behind the fold statistics does not repeat rows by fold;
    repeated and null keys are split as the written split does it."""
    from raremine import session

    plain, seen = session.written, {}
    monkeypatch.setattr(session, "written", lambda df, name: seen.setdefault(name, plain(df, name)))
    rows = [(None if i % 50 == 0 else f"k{i % 230}", float(i % 5 == 0), float(i % 7), float((i * i) % 11)) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, label double, f1 double, f2 double")
    pred = MO.gnb_fold_predictions(df, ["f1", "f2"], 40)
    assert seen["split"].count() == 300
    monkeypatch.setattr(session, "written", plain)
    count = lambda d: sorted((r.fold, str(r.id), r.label, r.n) for r in d.groupBy("fold", "id", "label").agg(F.count(F.lit(1)).alias("n")).collect())
    assert count(pred) == count(S.split_strat_shuffle(df, 40))


def test_fold_predictions_without_a_score(spark):
    rows = [(f"k{i}", float(i % 4 == 0), None if i == 8 else float("nan") if i == 9 else float(i % 4 + i % 3), 1.0 * i) for i in range(80)]
    df = spark.createDataFrame(rows, "id string, label double, f1 double, f2 double")
    got = MO.gnb_fold_predictions(df, ["f1", "f2"], 30).collect()
    assert len(got) == 30 * 8 and {r.prediction for r in got if r.id == "k8"} == {None}
    assert all(r.prediction in (0.0, 1.0) for r in got if r.id != "k8")
