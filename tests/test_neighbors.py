"""k-NN around pivots: the same rows as all pairs, from far fewer blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from raremine.operators import neighbors as NB


def frame(spark, x, groups=None):
    rows = [(i, *([int(groups[i])] if groups is not None else []), [float(c) for c in v]) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id long, " + ("g int, " if groups is not None else "") + "v array<double>")


def brute(x, k, groups=None):
    out = set()
    for i, v in enumerate(x):
        d2 = ((x - v) ** 2).sum(axis=1)
        d2[i] = np.inf
        if groups is not None:
            d2[groups != groups[i]] = np.inf
        best = sorted((d, j) for j, d in enumerate(d2) if np.isfinite(d))[:k]
        out.update((i, j, rank) for rank, (_, j) in enumerate(best, 1))
    return out


def result(df):
    return {(r.qid, r.rid, r["rank"]) for r in df.collect()}


@pytest.fixture
def blocks_met(monkeypatch):
    """Pairs of blocks dealt, per round."""
    seen = []
    real = NB._meet
    monkeypatch.setattr(NB, "_meet", lambda q, r, blocks, *a: seen.append(
        q.select(*blocks).distinct().join(r.select(*blocks).distinct(), list(blocks)).count()) or real(q, r, blocks, *a))
    return seen


def test_clustered_rows_meet_few_blocks(spark, blocks_met):
    r = np.random.default_rng(1)
    centres = r.normal(size=(30, 4)) * 50
    x = centres[r.integers(0, 30, 3000)] + r.normal(size=(3000, 4))
    x[2500:2900] = x[7]                                   # a hot spot of equal rows
    df = frame(spark, x)
    got = NB.knn_join(df, df, 4, block_rows=50, direct_pairs=1, pivot_rows=50)
    assert result(got) == brute(x, 4)
    every = 60 * 60
    assert len(blocks_met) == 2 and sum(blocks_met) < every / 4


def test_uniform_rows_and_other_queries(spark):
    r = np.random.default_rng(2)
    x, y = r.random((700, 6)), r.random((90, 6)) * 3 - 1
    got = {(a.qid, a.rid, a["rank"]) for a in NB.knn_join(frame(spark, y), frame(spark, x), 5, exclude_self=False, block_rows=40,
                                                         direct_pairs=1, pivot_rows=30).collect()}
    want = set()
    for i, v in enumerate(y):
        d2 = ((x - v) ** 2).sum(axis=1)
        want.update((i, j, rank) for rank, (_, j) in enumerate(sorted((d, j) for j, d in enumerate(d2))[:5], 1))
    assert got == want


def test_groups_and_fewer_rows_than_neighbours(spark):
    r = np.random.default_rng(3)
    x = np.round(r.normal(size=(400, 2)), 1)              # many ties
    groups = np.where(np.arange(400) < 3, 9, np.arange(400) % 3)
    df = frame(spark, x, groups)
    got = NB.knn_join(df, df, 6, block_rows=20, group="g", direct_pairs=1, pivot_rows=15)
    assert result(got) == brute(x, 6, groups)
    direct = NB.knn_join(df, df, 6, block_rows=20, group="g")
    assert result(direct) == brute(x, 6, groups)


def test_infinite_coordinates_raise(spark):
    df = frame(spark, np.ones((60, 2))).withColumn("v", F.when(F.col("id") == 5, F.array(F.lit(1.0), F.lit(float("inf")))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="finite"):
        NB.knn_join(df, df, 2, block_rows=10, direct_pairs=1, pivot_rows=10).count()


@pytest.mark.parametrize("apart", [False, True])
@pytest.mark.parametrize("direct", [1, 256])
def test_knn_without_folds_equals_the_search_in_each_group(spark, direct, apart):
    """Rows meet once for all folds; every fold left out has the neighbours that
    a search among its own rows finds, with repeated keys and rows, ties and
    folds that lie apart."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(260, 3)), 1)
    fold = (np.argsort(np.argsort(x[:, 0])) * 4 // 260) if apart else rng.integers(0, 4, 260)
    rows = [(f"k{i % 240}", int(f), v.tolist()) for i, (f, v) in enumerate(zip(fold, x))] + [("k7", 1, x[7].tolist())] * 2
    df = spark.createDataFrame(rows, "id string, fold int, v array<double>")
    queries = df.filter("pmod(xxhash64(id), 3) = 0")
    groups = [d.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(4)))).filter("g <> fold") for d in (queries, df)]
    how = {"block_rows": 32, "pivot_rows": 16, "direct_pairs": direct, "group": "g"}
    expected = NB.knn_join(*groups, 6, **how)
    found = NB.knn_join(queries, df, 6, **how, fold="fold", folds=5)
    one, two = (sorted((r.g, r.qid, r["rank"], r.dist) for r in d.collect()) for d in (expected, found))
    assert one == two and len({r[0] for r in one}) == 5


def test_smote_in_folds_holds_every_row_once(spark, monkeypatch):
    """Same synthetic rows as with rows repeated by group, which are not written."""
    import raremine.session as session

    rng = np.random.default_rng(5)
    rows = [(f"k{i}", int(i % 9 == 0 or i % 50 == 1), int(rng.integers(0, 5)), *rng.normal(size=2).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, label int, fold int, a double, b double")
    parts = df.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(4)))).filter("g <> fold")
    expected = NB.smote_borderline(parts, ["a", "b"], group="g").collect()
    sizes, plain = {}, session.written

    def counted(frame, name):
        done = plain(frame, name)
        sizes[name] = done.count()
        return done

    monkeypatch.setattr(session, "written", counted)
    found = NB.smote_borderline(df, ["a", "b"], group="g", fold="fold", folds=5)
    assert sorted(expected) == sorted(found.collect()) and len(expected) > 100
    assert sizes["smote-rows"] == 300


def test_blocks_meet_over_many_partitions(spark):
    """All pairs of blocks, where Spark keeps every shuffle partition."""
    x = np.random.default_rng(4).normal(size=(300, 3))
    names = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(n) for n in names]
    try:
        for n, v in zip(names, ("false", "13")):
            spark.conf.set(n, v)
        df = frame(spark, x)
        assert result(NB.knn_join(df, df, 4, block_rows=50)) == brute(x, 4)
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)


def test_rows_without_clusters_are_not_repeated_by_cell(spark, monkeypatch):
    """Where bounds exclude little, blocks meet as they are: no round writes every
    vector for every cell, and batches of visits stay small."""
    import raremine.session as session

    x = np.random.default_rng(6).normal(size=(700, 24))
    x[600:640] = x[3]                                     # ties
    sizes, plain = {}, session.written

    def counted(frame, name):
        done = plain(frame, name)
        sizes.setdefault(name, []).append(done.count())
        return done

    monkeypatch.setattr(session, "written", counted)
    monkeypatch.setattr(NB, "_QUERIES", 32)
    monkeypatch.setattr(NB, "_REFS", 16)
    df = frame(spark, x)
    got = NB.knn_join(df, df, 4, block_rows=60, direct_pairs=1, pivot_rows=20)
    assert result(got) == brute(x, 4)
    assert sum(sizes["knn-visits"]) < 3 * 700
    y = frame(spark, x[:50] + 0.01)
    other = NB.knn_join(y, df, 4, exclude_self=False, block_rows=20, direct_pairs=1, pivot_rows=20)
    d2 = ((x[:50, None] + 0.01 - x[None]) ** 2).sum(axis=2)
    assert result(other) == {(i, j, n) for i in range(50) for n, j in enumerate(np.lexsort((np.arange(700), d2[i]))[:4], 1)}


def test_visits_come_in_batches_of_bounded_size(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(NB, "VISIT_BYTES", 8 * 3 * 10)
    x = np.random.default_rng(1).normal(size=(40, 3))
    cells = {0: (np.arange(5), np.ones(5, np.int64), np.zeros(5), np.ones(5))}
    table = pd.DataFrame({"qid": range(40), "v": list(x)})
    out = list(NB._visits(x[:5], cells, 2, None, False)(iter([table])))
    assert max(map(len, out)) <= 10 and sum(map(len, out)) == 40 * 3
