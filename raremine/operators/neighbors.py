"""Exact k-nearest neighbours, the k-NN vote and borderline SMOTE.

k-NN join without materialising all pairs as rows.  Few rows: both sides are
split into hash blocks of bounded size, and every (query block, reference
block) pair is one cogroup task that computes distances in numpy and emits only
its local top-k per query row.  Many rows: reference rows are dealt to cells by
their nearest pivot (a bounded sample of reference rows).  A query first meets
the cells around it; the distance of its k-th neighbour there bounds the
search, and it then meets only cells that may hold a nearer row, by the
triangle inequality (distances to the pivot in a cell lie between its least and
its largest) and by the plane between two pivots.  Cells are blocks again, so
no task depends on how many rows or queries crowd around one pivot.

A ``row_number() <= k`` over the candidates per query (a partial
WindowGroupLimit) gives the exact global top-k.  Ties are broken by the
reference key, so the result does not depend on partitioning.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raremine import SEED
from raremine.functions.numeric import hash_key, hash_uniform

# functions of this module run in tasks of executors that lack the repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 2048
_CHUNK = 64
#: Pairs of blocks up to which all of them are compared; rows per pivot aimed
#: at; pivots (and so numbers on the driver: pivots x columns) at most.
DIRECT_PAIRS, PIVOT_ROWS, MAX_PIVOTS = 256, 1024, 4096
#: Bytes of vectors in a batch of visits, and in a block where all blocks meet;
#: share of all pairs from which they do; queries that tell the share.
VISIT_BYTES, BLOCK_BYTES, MOST_PAIRS, ASKED = 4 << 20, 16 << 20, 0.25, 4096
_QUERIES, _REFS = 128, 4096


def as_vector(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def _near_without(row: np.ndarray, part: np.ndarray, folds: int, k: int) -> np.ndarray:
    """Which candidates (by row, nearest first) are among the row's k nearest
    of all folds but one, for some fold left out."""
    first = np.searchsorted(row, row)
    keep = np.zeros(len(row), bool)
    for g in range(folds):
        other = part != g
        n = np.cumsum(other)
        keep |= other & (n - n[first] + other[first] <= k)
    return keep


def _bound_without(near: np.ndarray, bound: np.ndarray, part: np.ndarray, folds: int, kk: int) -> np.ndarray:
    """``bound`` raised for the rows (few, unless folds lie apart) where a fold
    left out leaves fewer than ``kk`` within it."""
    row, col = np.nonzero(near <= bound[:, None])
    within = np.bincount(row * folds + part[col], minlength=len(near) * folds).reshape(-1, folds)
    without = within.sum(axis=1)[:, None] - within
    for g in range(folds):
        other = np.flatnonzero(part != g)
        few = np.flatnonzero(without[:, g] < min(kk, len(other)))
        if len(few):
            kth = np.partition(near[np.ix_(few, other)], min(kk, len(other)) - 1, axis=1)[:, min(kk, len(other)) - 1]
            bound[few] = np.maximum(bound[few], kth)
    return bound


def _local_topk(k: int, exclude_self: bool, group: str | None, folds: int = 0):
    def fn(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        qid_all, rid_all = q["qid"].to_numpy(), r["rid"].to_numpy()
        gval = q[group].to_numpy()[:1] if group else None
        if q.empty or r.empty:
            out = {"qid": qid_all[:0], "rid": rid_all[:0], "d2": np.zeros(0)}
            if group:
                out = {group: q[group].to_numpy()[:0], **out}
            if folds:
                out |= {"qpart": np.zeros(0, np.int32), "rpart": np.zeros(0, np.int32)}
            return pd.DataFrame(out)
        qv = np.stack(q["v"].to_numpy()).astype(np.float64)
        rv = np.stack(r["v"].to_numpy()).astype(np.float64)
        if not (np.isfinite(qv).all() and np.isfinite(rv).all()):
            raise ValueError("k-NN vectors need finite coordinates; impute or drop rows first")
        order_r = np.argsort(rid_all, kind="stable")          # tie-break by reference key
        rv, rid = rv[order_r], rid_all[order_r]
        kk = min((2 * k if folds else k) + exclude_self, len(rid))
        if folds:
            qpart, rpart = q["qpart"].to_numpy(), r["rpart"].to_numpy()[order_r]
            out_p, out_s = [qpart[:0]], [rpart[:0]]
        rn = (rv ** 2).sum(axis=1)
        # rows beyond ``theta`` are not among the k nearest, whatever else is here
        theta = q["theta"].to_numpy() if "theta" in q else np.full(len(q), np.inf)
        out_q, out_r, out_d = [qid_all[:0]], [rid[:0]], [np.zeros(0)]
        for s in range(0, len(qid_all), _CHUNK):
            qid, x = qid_all[s:s + _CHUNK], qv[s:s + _CHUNK]
            # a matrix product finds the candidates: all within its rounding error of the k-th
            xn = (x ** 2).sum(axis=1)
            near = xn[:, None] + rn[None, :] - 2.0 * (x @ rv.T)
            slack = 1e-11 * (xn + rn.max() + 1e-300) * x.shape[1]
            bound = theta[s:s + _CHUNK] ** 2 + slack
            many = np.flatnonzero((near <= bound[:, None]).sum(axis=1) > 4 * kk)
            if len(many):
                some = near[many]
                kth = np.partition(some, kk - 1, axis=1)[:, kk - 1]
                if folds:
                    kth = _bound_without(some, kth, rpart, folds, k + exclude_self)
                bound[many] = np.minimum(bound[many], kth + slack[many])
            row, col = np.nonzero(near <= bound[:, None])
            d2 = ((x[row] - rv[col]) ** 2).sum(axis=1)
            if exclude_self:
                other = qid[row] != rid[col]
                row, col, d2 = row[other], col[other], d2[other]
            # by row, then distance; columns are in key order already, and the sort is stable
            order = np.lexsort((d2, row))
            row, col, d2 = row[order], col[order], d2[order]
            if folds:
                keep = _near_without(row, rpart[col], folds, k)
                out_p.append(qpart[s:s + _CHUNK][row[keep]])
                out_s.append(rpart[col[keep]])
            else:
                first = np.searchsorted(row, np.arange(len(qid)))
                keep = np.arange(len(row)) - first[row] < k
            out_q.append(qid[row[keep]])
            out_r.append(rid[col[keep]])
            out_d.append(d2[keep])
        out = {"qid": np.concatenate(out_q), "rid": np.concatenate(out_r), "d2": np.concatenate(out_d)}
        if group:
            out = {group: np.repeat(gval, len(out["qid"])), **out}
        if folds:
            out |= {"qpart": np.concatenate(out_p), "rpart": np.concatenate(out_s)}
        return pd.DataFrame(out)
    return fn


def _max_group_count(df: DataFrame, group: str | None) -> int:
    if group is None:
        return df.count()
    row = df.groupBy(group).count().agg(F.max("count")).first()
    return int(row[0] or 0)


def knn_join(queries: DataFrame, refs: DataFrame, k: int, qkey: str = "id", rkey: str = "id",
             vec: str = "v", exclude_self: bool = True, block_rows: int = BLOCK_ROWS,
             group: str | None = None, sizes: tuple[int, int] | None = None,
             direct_pairs: int = DIRECT_PAIRS, pivot_rows: int = PIVOT_ROWS, fold: str | None = None,
             folds: int = 0) -> DataFrame:
    """``([group,] qid, rid, rank, dist)``: the k nearest reference rows of
    every query row by Euclidean distance (self excluded by key when
    ``exclude_self``).  Null or non-finite coordinates raise a ValueError.  With
    ``group``, neighbours are searched within the same group only (e.g. the
    training rows of one fold).  Beyond ``direct_pairs`` pairs of blocks, cells
    around pivots (one per ``pivot_rows`` rows) tell which blocks need not meet.

    With ``fold`` (a column of 0 to ``folds`` - 1 on both sides) the groups are
    the training rows of each fold: ``group`` names the fold left out, and every
    query is answered for each but its own.  Rows meet once for all groups."""
    if fold:
        return _knn_without_folds(queries, refs, k, qkey, rkey, vec, exclude_self, block_rows, group, sizes,
                                  direct_pairs, pivot_rows, fold, folds)
    gcols = [group] if group else []
    # block counts from (largest group) sizes; callers that know them pass ``sizes``
    nq, nr = sizes if sizes else (_max_group_count(queries, group), _max_group_count(refs, group))
    qb, rb = max(1, math.ceil(nq / block_rows)), max(1, math.ceil(nr / block_rows))
    # re-alias the group column on each side: both sides may come from the
    # same frame, and the cogroup must not see one attribute twice
    q = queries.select(*[F.col(g).alias(g) for g in gcols], F.col(qkey).alias("qid"), F.col(vec).cast("array<double>").alias("v"))
    r = refs.select(*[F.col(g).alias(g) for g in gcols], F.col(rkey).alias("rid"), F.col(vec).cast("array<double>").alias("v"))
    if qb * rb > direct_pairs and rb > 1:
        cand = _pivot_candidates(q, r, k, exclude_self, block_rows, group, nr, pivot_rows, nq=nq)
    else:
        cand = _meet(*_all_blocks(q, r, qb, rb), ["qb", "rb"], k, exclude_self, group)
    w = Window.partitionBy(*gcols, "qid").orderBy("d2", "rid")
    return (cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select(*gcols, "qid", "rid", F.col("rank").cast("int"), F.sqrt("d2").alias("dist")))


def _knn_without_folds(queries: DataFrame, refs: DataFrame, k: int, qkey: str, rkey: str, vec: str, exclude_self: bool,
                       block_rows: int, group: str, sizes: tuple[int, int] | None, direct_pairs: int, pivot_rows: int,
                       fold: str, folds: int) -> DataFrame:
    """``knn_join`` among the rows of all folds but one, for each fold left out."""
    nq, nr = sizes if sizes else (queries.count(), refs.count())
    qb, rb = max(1, math.ceil(nq / block_rows)), max(1, math.ceil(nr / block_rows))
    q = queries.select(F.col(qkey).alias("qid"), F.col(vec).cast("array<double>").alias("v"), F.col(fold).cast("int").alias("qpart"))
    r = refs.select(F.col(rkey).alias("rid"), F.col(vec).cast("array<double>").alias("v"), F.col(fold).cast("int").alias("rpart"))
    if qb * rb > direct_pairs and rb > 1:
        cand = _pivot_candidates(q, r, k, exclude_self, block_rows, None, nr, pivot_rows, folds)
    else:
        cand = _meet(*_all_blocks(q, r, qb, rb), ["qb", "rb"], k, exclude_self, None, folds)
    w = Window.partitionBy(group, "qid").orderBy("d2", "rid")
    return (cand.withColumn(group, _answered(folds)).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select(group, "qid", "rid", F.col("rank").cast("int"), F.sqrt("d2").alias("dist")))


def _answered(folds: int) -> Column:
    """A row for every fold that holds neither the query nor the reference row."""
    return F.explode(F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda g: (g != F.col("qpart")) & (g != F.col("rpart"))))


def _all_blocks(q: DataFrame, r: DataFrame, qb: int, rb: int) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt over all pairs of hash blocks.  Block numbers are long on
    both: equal numbers of other types are shuffled to other partitions."""
    def block(key, n):
        return F.pmod(F.xxhash64(key), F.lit(n).cast("long"))

    def every(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    return (q.withColumn("qb", block("qid", qb)).withColumn("rb", every(rb)),
            r.withColumn("rb", block("rid", rb)).withColumn("qb", every(qb)))


def _meet(q: DataFrame, r: DataFrame, blocks: Sequence[str], k: int, exclude_self: bool, group: str | None,
          folds: int = 0) -> DataFrame:
    """([group,] qid, rid, d2[, qpart, rpart]): the k nearest rows of each pair of
    blocks (with ``folds``, of each set of folds but one)."""
    types = dict(q.dtypes) | dict(r.dtypes)
    keys = ([group] if group else []) + list(blocks)
    head = f"{group} {types[group]}, " if group else ""
    return (q.groupBy(*keys).cogroup(r.groupBy(*keys))
            .applyInPandas(_local_topk(k, exclude_self, group, folds),
                           f"{head}qid {types['qid']}, rid {types['rid']}, d2 double{', qpart int, rpart int' if folds else ''}"))


def _to_pivots(v, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows as a matrix, and their distances to all pivots."""
    x = np.stack(v.to_numpy()).astype(np.float64)
    if not np.isfinite(x).all():
        raise ValueError("k-NN vectors need finite coordinates; impute or drop rows first")
    d2 = (x ** 2).sum(axis=1)[:, None] + (pivots ** 2).sum(axis=1)[None, :] - 2.0 * (x @ pivots.T)
    return x, np.sqrt(np.maximum(d2, 0.0))


def _visits(pivots: np.ndarray, cells: dict, k: int, group: str | None, second: bool):
    """Function over query batches -> rows of (group, qid, v, cell) for every
    cell to meet.  First round: the nearest cells that hold more than k rows
    together.  Second round: the others whose bound is within ``theta``."""
    size = max(64, (1 << 20) // max(1, len(pivots)))

    def run(batches):
        # pivots x pivots numbers: made in the task, not sent to it
        gap = np.sqrt(np.maximum((pivots ** 2).sum(axis=1)[:, None] + (pivots ** 2).sum(axis=1)[None, :] - 2.0 * pivots @ pivots.T, 0.0)
                      ) if second else None
        for table in batches:
            for lo in range(0, len(table), size):
                part = table.iloc[lo:lo + size]
                x, d = _to_pivots(part["v"], pivots)
                # rounding of distances from matrix products
                slack = 1e-6 * (1.0 + np.sqrt((x ** 2).sum(axis=1).max()) + np.abs(pivots).max())
                rows, cols = [], []
                groups = part[group].to_numpy() if group else np.zeros(len(part), np.int64)
                for g in dict.fromkeys(groups.tolist()):
                    cell, count, least, most = cells.get(g, (np.zeros(0, np.int64),) * 4)
                    if not len(cell):
                        continue
                    at = np.flatnonzero(groups == g)
                    dg = d[np.ix_(at, cell)]
                    order = np.argsort(dg, axis=1, kind="stable")
                    have = np.cumsum(count[order], axis=1)
                    n_home = (have < k + 1).sum(axis=1) + 1         # cells up to the one that makes it enough
                    place = np.empty_like(order)
                    np.put_along_axis(place, order, np.arange(len(cell))[None, :], axis=1)
                    home = place < n_home[:, None]
                    if second:
                        own = order[:, 0]
                        bound = np.maximum(dg - most[None, :], least[None, :] - dg)
                        between = gap[np.ix_(cell[own], cell)]
                        near = np.take_along_axis(dg, own[:, None], axis=1)
                        with np.errstate(divide="ignore", invalid="ignore"):
                            plane = np.where(between > 0, (dg ** 2 - near ** 2) / (2 * between), 0.0)
                        bound = np.maximum(bound, plane) - slack
                        take = ~home & (bound <= part["theta"].to_numpy()[at][:, None])
                    else:
                        take = home
                    i, j = np.nonzero(take)
                    rows.append(at[i])
                    cols.append(cell[j])
                if rows:
                    i, c = np.concatenate(rows), np.concatenate(cols)
                    # a row with its vector for each cell it meets: a batch of bounded size at a time
                    step = max(1, VISIT_BYTES // (8 * max(1, pivots.shape[1])))
                    for at in range(0, len(i), step):
                        out = part.iloc[i[at:at + step]].copy()
                        out["cell"] = c[at:at + step].astype(np.int32)
                        yield out
    return run


def _met_rows(visits_of, cells: dict):
    """Function over query batches -> how many rows they would meet (n)."""
    def run(batches):
        cell, count, _, _ = cells[0]
        size = np.zeros(int(cell.max()) + 1, np.int64)
        size[cell] = count
        met = 0
        for visits in visits_of(batches):
            met += int(size[visits["cell"].to_numpy()].sum())
        yield pd.DataFrame({"n": [met]})
    return run


def _block_topk(k: int, exclude_self: bool):
    """Function over a query table (qid, v, theta) and a reference table (rid, v)
    -> (qid, rid, d2): the k nearest rows within ``theta``.  The tables' vectors
    are looked at where they lie; distances are made for a few MB of pairs at once."""
    def matrix(table):
        v = table.column("v").combine_chunks()
        v = v.chunk(0) if isinstance(v, pa.ChunkedArray) else v
        x = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(v), -1)
        if not np.isfinite(x).all():
            raise ValueError("k-NN vectors need finite coordinates; impute or drop rows first")
        return x

    def fn(q: pa.Table, r: pa.Table) -> pa.Table:
        ids = (q.column("qid").combine_chunks(), r.column("rid").combine_chunks())
        qid, rid = (v.chunk(0) if isinstance(v, pa.ChunkedArray) and v.num_chunks else v for v in ids)
        rows, cols, dist = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if q.num_rows and r.num_rows:
            qv, rv = matrix(q), matrix(r)
            place = np.empty(len(rv), np.int64)                       # of each row in key order: breaks ties
            place[pc.sort_indices(rid).to_numpy()] = np.arange(len(rv))
            same = pc.index_in(qid, rid).fill_null(-1).to_numpy(zero_copy_only=False) if exclude_self else None
            codes = pc.index_in(rid, rid).fill_null(-1).to_numpy(zero_copy_only=False) if exclude_self else None
            kk = min(k + exclude_self, len(rv))
            rn = (rv ** 2).sum(axis=1)
            theta = q.column("theta").to_numpy()
            for s in range(0, len(qv), _QUERIES):
                x = qv[s:s + _QUERIES]
                xn = (x ** 2).sum(axis=1)
                # a matrix product finds the candidates: all within its rounding error of the k-th
                slack = 1e-11 * (xn + rn.max() + 1e-300) * x.shape[1]
                bound = theta[s:s + _QUERIES] ** 2 + slack
                row, col, near = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
                for t in range(0, len(rv), _REFS):
                    d = x @ rv[t:t + _REFS].T
                    d *= -2.0
                    d += xn[:, None]
                    d += rn[None, t:t + _REFS]
                    hit = d <= bound[:, None]
                    if d.shape[1] > 4 * kk:
                        many = np.flatnonzero(hit.sum(axis=1) > 4 * kk)
                        if len(many):
                            bound[many] = np.minimum(bound[many], np.partition(d[many], kk - 1, axis=1)[:, kk - 1] + slack[many])
                            hit[many] = d[many] <= bound[many][:, None]
                    i, j = np.nonzero(hit)
                    row, col, near = np.concatenate([row, i]), np.concatenate([col, j + t]), np.concatenate([near, d[i, j]])
                    # what was kept tells how near the k-th is at most
                    order = np.lexsort((near, row))
                    row, col, near = row[order], col[order], near[order]
                    first = np.searchsorted(row, np.arange(len(x)))
                    full = np.flatnonzero(np.bincount(row, minlength=len(x)) >= kk)
                    bound[full] = np.minimum(bound[full], near[first[full] + kk - 1] + slack[full])
                    keep = near <= bound[row]
                    row, col, near = row[keep], col[keep], near[keep]
                d2 = ((x[row] - rv[col]) ** 2).sum(axis=1)
                if exclude_self:
                    other = (same[s + row] < 0) | (same[s + row] != codes[col])
                    row, col, d2 = row[other], col[other], d2[other]
                order = np.lexsort((place[col], d2, row))
                row, col, d2 = row[order], col[order], d2[order]
                keep = np.arange(len(row)) - np.searchsorted(row, row) < k
                rows.append(s + row[keep])
                cols.append(col[keep])
                dist.append(d2[keep])
        rows, cols = pa.array(np.concatenate(rows)), pa.array(np.concatenate(cols))
        return pa.table({"qid": qid.take(rows), "rid": rid.take(cols), "d2": pa.array(np.concatenate(dist))})
    return fn


def _meet_all(q: DataFrame, r: DataFrame, nq: int, nr: int, width: int, k: int, exclude_self: bool) -> DataFrame:
    """(qid, rid, d2): the k nearest rows, within ``theta``, of each pair of blocks
    when all of them meet.  A row is sent once for each block of the other side,
    so blocks are as large as a task may hold: ``BLOCK_BYTES`` of vectors."""
    least = math.isqrt(DIRECT_PAIRS)
    qb, rb = (max(least, -(-n * width * 8 // BLOCK_BYTES)) for n in (nq, nr))
    types = dict(q.dtypes) | dict(r.dtypes)
    q, r = _all_blocks(q.select("qid", "v", "theta"), r.select("rid", "v"), qb, rb)
    return (q.groupBy("qb", "rb").cogroup(r.groupBy("qb", "rb"))
            .applyInArrow(_block_topk(k, exclude_self), f"qid {types['qid']}, rid {types['rid']}, d2 double"))


def _pivot_candidates(q: DataFrame, r: DataFrame, k: int, exclude_self: bool, block_rows: int, group: str | None, nr: int,
                      pivot_rows: int, folds: int = 0, nq: int = 0) -> DataFrame:
    """([group,] qid, rid, d2) that hold every query's k nearest rows (with
    ``folds``, those of all folds but one, whichever is left out).  Where a few
    queries tell that the bounds exclude little, all blocks meet instead: the
    rows found are the same, and vectors are not repeated for every cell."""
    from raremine.session import written

    spark = q.sparkSession
    gcols = [group] if group else []
    wanted = min(MAX_PIVOTS, max(2, math.ceil(nr / pivot_rows)))
    sample = r.orderBy(F.xxhash64("rid"), "rid").limit(2 * wanted).select("v").collect()     # bounded by MAX_PIVOTS
    pivots = np.unique(np.array([x[0] for x in sample], dtype=np.float64), axis=0)
    pivots = pivots[np.random.default_rng(SEED).permutation(len(pivots))[:wanted]]

    def assign(batches):
        for table in batches:
            if len(table):
                _, d = _to_pivots(table["v"], pivots)
                out = table.copy()
                out["cell"] = d.argmin(axis=1).astype(np.int32)
                out["d"] = d.min(axis=1)
                yield out

    def schema(df, extra):
        return ", ".join(f"{c} {t}" for c, t in df.dtypes) + extra

    r = written(r.mapInPandas(assign, schema(r, ", cell int, d double")), "knn-cells")
    found = r.groupBy(*gcols, "cell").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("least"), F.max("d").alias("most"))
    table = found.toPandas()                                    # groups x pivots rows
    cells = {}
    for g, t in (table.groupby(group) if group else [(0, table)]):
        cells[g] = (t["cell"].to_numpy(np.int64), t["n"].to_numpy(np.int64), t["least"].to_numpy(), t["most"].to_numpy())
    blocks = spark.createDataFrame(table.assign(nb=-(-table["n"] // block_rows))[[*gcols, "cell", "nb"]],
                                   ", ".join([f"{g} {dict(r.dtypes)[g]}" for g in gcols] + ["cell int, nb long"]))
    r = (r.drop("d").join(F.broadcast(blocks), [*gcols, "cell"])
         .withColumn("rb", F.pmod(F.xxhash64("rid"), F.col("nb"))))

    cell = [*gcols, "cell"]

    def meet(visits):
        visits = written(visits, "knn-visits")
        chunks = visits.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).alias("nc"))   # groups x pivots rows
        mine = (visits.join(F.broadcast(blocks), cell).join(F.broadcast(chunks), cell)
                .withColumn("qb", F.pmod(F.xxhash64("qid"), F.col("nc")))
                .withColumn("rb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1))).drop("nb", "nc"))
        theirs = (r.join(F.broadcast(chunks), cell)
                  .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nc") - 1))).drop("nb", "nc"))
        return _meet(mine, theirs, ["cell", "qb", "rb"], k, exclude_self, group, folds)

    need = 2 * k if folds else k
    first = written(meet(q.mapInPandas(_visits(pivots, cells, need, group, False), schema(q, ", cell int"))), "knn-near")
    if folds:
        gcols = ["qpart"]
        w = Window.partitionBy("qpart", "_out", "qid").orderBy("d2", "rid")
        # the farthest k-th neighbour over the folds left out; none if one of them has fewer
        kth = (first.withColumn("_out", _answered(folds)).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") == k)
               .groupBy("qpart", "qid").agg(F.sqrt(F.max("d2")).alias("theta"), F.count(F.lit(1)).alias("_n"))
               .filter(F.col("_n") == folds - 1).drop("_n"))
    else:
        w = Window.partitionBy(*gcols, "qid").orderBy("d2", "rid")
        kth = (first.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") == k)
               .select(*gcols, "qid", F.sqrt("d2").alias("theta")))
    bounded = q.join(kth, [*gcols, "qid"], "left").withColumn("theta", F.coalesce("theta", F.lit(float("inf")))).select(*q.columns, "theta")
    if not folds and not group and nq:
        bounded = written(bounded, "knn-bounded")
        asked = bounded.filter(F.pmod(F.xxhash64("qid"), F.lit(max(1, nq // ASKED)).cast("long")) == 0)
        met = asked.mapInPandas(_met_rows(_visits(pivots, cells, need, group, True), cells), "n long").agg(F.sum("n")).first()[0] or 0
        if met > MOST_PAIRS * asked.count() * nr:
            return _meet_all(bounded, r, nq, nr, pivots.shape[1], k, exclude_self)
    second = meet(bounded.mapInPandas(_visits(pivots, cells, need, group, True), schema(bounded, ", cell int")))
    return first.unionByName(second)


def knn_vote(test: DataFrame, train: DataFrame, k: int = 5, key: str = "id", label: str = "label",
             vec: str = "v", group: str | None = None, tested: DataFrame | None = None, folds: int = 0,
             near: DataFrame | None = None) -> DataFrame:
    """k-NN classifier: majority label of the k nearest training rows; ties
    go to the smaller label.  ``([group,] key, label, prediction)``.  With ``group``
    (e.g. a fold id on both sides) every group is a classifier of its own, all in
    the same jobs.

    With ``tested`` ((group, key) of rows left out of groups 0 to ``folds`` - 1)
    ``train`` holds every row once, ``test`` is some of its rows for some groups, and
    ``near`` is ``knn_join`` of ``train`` with itself for more than k neighbours: the
    first k of them that a group trains are its nearest.  Queries with fewer left
    are searched again, group by group."""
    gcols = [group] if group else []
    from raremine.operators.joins import salted_join

    if tested is None:
        nn = knn_join(test.select(*gcols, key, vec), train.select(*gcols, key, vec), k, key, key, vec, exclude_self=False, group=group)
        lab = train.select(*gcols, F.col(key).alias("rid"), F.col(label).alias("_nl"))
        join_on = [*gcols, "rid"]
    else:
        nn = _nearest_trained(test, train, k, key, vec, group, tested, folds, near)
        lab = train.select(F.col(key).alias("rid"), F.col(label).alias("_nl"))
        join_on = ["rid"]
    # a "hub" row can be a neighbour of many queries: salt its key
    votes = salted_join(nn, lab, join_on, "inner").groupBy(*gcols, "qid", "_nl").agg(F.count(F.lit(1)).alias("_votes"))
    best = votes.groupBy(*gcols, "qid").agg(F.max_by("_nl", F.struct(F.col("_votes"), -F.col("_nl"))).alias("prediction"))
    return (test.select(*gcols, key, label).join(best.withColumnRenamed("qid", key), [*gcols, key], "left")
            .select(*gcols, key, label, "prediction"))


def _nearest_trained(test: DataFrame, train: DataFrame, k: int, key: str, vec: str, group: str, tested: DataFrame, folds: int,
                     near: DataFrame) -> DataFrame:
    """(group, qid, rid): the k nearest rows that each group trains, of the rows asked for it."""
    from raremine.operators.joins import salted_join
    from raremine.session import written

    asked = test.groupBy(F.col(key).alias("qid")).agg(F.collect_set(group).alias("_asked"))         # up to ``folds`` numbers a row
    left_out = tested.groupBy(F.col(key).alias("rid")).agg(F.collect_set(group).alias("_out"))
    pairs = salted_join(near.join(asked, "qid"), left_out, ["rid"], "left")
    kept = F.when(F.col("_out").isNull(), F.col("_asked")).otherwise(F.array_except("_asked", "_out"))
    w = Window.partitionBy(group, "qid").orderBy("rank")
    nn = written(pairs.select(F.explode(kept).alias(group), "qid", "rid", "rank").withColumn("_n", F.row_number().over(w))
                 .filter(F.col("_n") <= k).select(group, "qid", "rid"), "knn-trained")
    found = nn.groupBy(group, "qid").agg(F.count(F.lit(1)).alias("_n"))
    short = written(test.select(group, key, vec).join(found.withColumnRenamed("qid", key), [group, key], "left")
                    .filter(F.coalesce("_n", F.lit(0)) < k).filter(F.col(key).isNotNull()).drop("_n"), "knn-short")
    if short.limit(1).count() == 0:
        return nn
    every = train.select(key, vec).withColumn(group, F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    again = knn_join(short, every.join(tested.select(group, key), [group, key], "left_anti"), k, key, key, vec, exclude_self=False, group=group)
    rest = nn.join(short.select(group, F.col(key).alias("qid")), [group, "qid"], "left_anti")
    return rest.unionByName(again.select(group, "qid", "rid"))


def smote_borderline(df: DataFrame, features: Sequence[str], label: str = "label", key: str = "id",
                     minority=1, m_neighbors: int = 10, k_neighbors: int = 5,
                     seed: int = SEED, group: str | None = None, fold: str | None = None, folds: int = 0) -> DataFrame:
    """Borderline-1 SMOTE: synthetic minority rows up to class balance.

    * danger rows: minority rows whose m nearest neighbours (all rows) hold at
      least m/2 and fewer than m majority rows;
    * candidate pairs: each danger row with its k nearest minority rows;
    * n_new = n_majority - n_minority rows are shared evenly over the pairs
      (the first n_new mod P pairs in md5 order get one more);
    * new row = x + u * (neighbour - x), u = md5-uniform of (seed, pair, copy).

    With ``group`` (e.g. a fold id) every group is resampled on its own rows
    in the same jobs -- scope 'train' of the evaluation.  With ``fold`` (a column
    of 0 to ``folds`` - 1) the groups are the rows of all folds but one: ``group``
    names the one left out, and rows are not repeated by group.  Returns
    ``([group,] key, source, neighbour, copy, *features, label)`` of the
    synthetic rows only; a group without danger rows gets none."""
    from raremine.operators.clean import global_row_number
    from raremine.session import written

    gcols = [group] if group else []
    held = [fold] if fold else gcols               # what tells the rows of a group apart in base
    base = written(df.select(*held, key, label, as_vector(features).alias("v")), "smote-rows")
    is_min = F.col(label) == F.lit(minority)
    stats = {}
    for r in base.groupBy(*held, is_min.alias("m")).count().collect():   # 2 rows per group
        for g in ([x for x in range(folds) if x != r[fold]] if fold else [r[group] if group else None]):
            own = stats.setdefault(g, {True: 0, False: 0})
            own[r["m"]] = own.get(r["m"], 0) + r["count"]
    n_new = {g: v[False] - v[True] for g, v in stats.items() if v[False] > v[True] and v[True] >= 2}
    empty = df.sparkSession.createDataFrame([], _smote_schema(df, key, features, label, group, fold))
    if not n_new:
        return empty
    minority_rows = base.filter(is_min)
    max_min = max(v[True] for v in stats.values())
    max_all = max(v[True] + v[False] for v in stats.values())
    nn_all = written(knn_join(minority_rows, base, m_neighbors, key, key, "v", exclude_self=True, group=group,
                              sizes=(max_min, max_all), fold=fold, folds=folds), "smote-near")   # n_min x m rows, read twice
    labels = base.select(*held, F.col(key).alias("rid"), F.col(label).alias("_rl"))
    from raremine.operators.joins import salted_join

    # a "hub" row can be a neighbour of many queries: salt its key
    trains = (F.col(fold) != F.col(group)) if fold else F.lit(True)
    n_maj_nn = (salted_join(nn_all, labels, ([] if fold else gcols) + ["rid"], "inner").filter(trains).groupBy(*gcols, "qid")
                .agg(F.count_if(F.col("_rl") != F.lit(minority)).alias("_nmaj")))
    danger = (n_maj_nn.filter((F.col("_nmaj") >= m_neighbors / 2.0) & (F.col("_nmaj") < m_neighbors))
              .select(*gcols, F.col("qid").alias(key)))
    if fold:
        danger = written(danger, "smote-danger")
    danger_rows = minority_rows.join(danger, ([] if fold else gcols) + [key], "left_semi")
    pairs = knn_join(danger_rows, minority_rows, k_neighbors, key, key, "v", exclude_self=True, group=group,
                     sizes=(max_min, max_min), fold=fold, folds=folds)
    if fold:                                       # a row is a query for all folds, in danger for some
        pairs = pairs.join(danger.withColumnRenamed(key, "qid"), gcols + ["qid"], "left_semi")
    pairs = written(pairs, "smote-pairs")          # read twice
    n_pairs = {(r[group] if group else None): r["count"] for r in pairs.groupBy(*gcols).count().collect()}
    plan = []                                      # per group: (group, per, extra, offset)
    off = 0
    for g in sorted(n_pairs, key=lambda x: (x is None, x)):
        if g in n_new and n_pairs[g] > 0:
            per, extra = divmod(n_new[g], n_pairs[g])
            plan.append((g, per, extra, off))
        off += n_pairs[g]
    if not plan:
        return empty
    hash_parts = ([F.col(group)] if group else []) + [F.col("qid"), F.col("rid")]
    ranked = global_row_number(pairs.withColumn("_h", hash_key(seed, *hash_parts)),
                               gcols + ["_h", "qid", "rid"], "_pr")
    if group:
        gtype = dict(pairs.dtypes)[group]
        plan_df = df.sparkSession.createDataFrame(plan, f"{group} {gtype}, _per long, _extra long, _off long")
        ranked = ranked.join(F.broadcast(plan_df), group)       # one row per group
    else:
        _, per, extra, _ = plan[0]
        ranked = ranked.select("*", F.lit(per).alias("_per"), F.lit(extra).alias("_extra"), F.lit(0).alias("_off"))
    in_group = F.col("_pr") - F.col("_off")
    copies = F.col("_per") + F.when(in_group <= F.col("_extra"), 1).otherwise(0)
    chosen = (ranked.filter(copies > 0)
              .withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))))
    src = base.select(*held, F.col(key).alias("qid"), F.col("v").alias("_x"))
    nbr = base.select(*held, F.col(key).alias("rid"), F.col("v").alias("_n"))
    u = hash_uniform(seed, *hash_parts, F.col("copy"))
    if fold:
        joined = chosen.join(src, "qid").filter(trains).drop(fold).join(nbr, "rid").filter(trains).withColumn("_u", u)
    else:
        joined = chosen.join(src, gcols + ["qid"]).join(nbr, gcols + ["rid"]).withColumn("_u", u)
    feats = [(F.col("_x")[j] + F.col("_u") * (F.col("_n")[j] - F.col("_x")[j])).alias(f)
             for j, f in enumerate(features)]
    sid = F.concat_ws("|", F.lit("smote"), F.col("qid").cast("string"), F.col("rid").cast("string"),
                      F.col("copy").cast("string"))
    return joined.select(*gcols, sid.alias(key), F.col("qid").alias("source"), F.col("rid").alias("neighbour"),
                         F.col("copy").cast("int"), *feats, F.lit(minority).cast(dict(df.dtypes)[label]).alias(label))


def _smote_schema(df: DataFrame, key: str, features, label: str, group: str | None = None, fold: str | None = None) -> T.StructType:
    kt = df.schema[key].dataType
    head = [T.StructField(group, T.IntegerType() if fold else df.schema[group].dataType)] if group else []
    return T.StructType(head + [T.StructField(key, T.StringType()), T.StructField("source", kt),
                                T.StructField("neighbour", kt), T.StructField("copy", T.IntegerType())]
                        + [T.StructField(f, T.DoubleType()) for f in features]
                        + [T.StructField(label, df.schema[label].dataType)])


def smote_resample(df: DataFrame, features: Sequence[str], label: str = "label", key: str = "id",
                   **kw) -> DataFrame:
    """Original rows plus synthetic ones (scope 'global' as in the reference;
    call it on a training fold only for scope 'train')."""
    syn = smote_borderline(df, features, label, key, **kw)
    orig = df.select(F.col(key).cast("string").alias(key), *[F.col(f).cast("double") for f in features], label)
    return orig.unionByName(syn.select(key, *features, label))
