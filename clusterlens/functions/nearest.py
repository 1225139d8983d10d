"""Nearest-centre assignment (cluster id + Euclidean distance in one pass).

The centres of a k-means model are O(k*d) values. They are collected to the
driver behind a size check and shipped to executors as broadcast blocks; the
points are never moved or paired with centres, so the work is one narrow
pass over the data whatever the data size.

Equivalent kernels:

* ``method="arrow"`` (default): a scalar Arrow UDF. Each Arrow batch of the
  feature column is reshaped zero-copy into an (m, d) matrix; candidate
  winners come from one matrix product, and rows whose two best candidates
  are within the rounding error of that product are re-decided by exact
  differences, so the winner is the one exact differencing picks.
  A set of ``MANY_CENTERS`` or more goes through balls of centres
  (``center_balls``), which leave out centres too far away to win;
  ``method="balls"`` does so for a set of any size.
* ``method="hof"``: the same rule written with built-in higher-order
  functions; slower, used as the executable reference in tests.

Ties go to the lowest cluster id in all kernels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterlens.functions.center_balls import CenterBalls
from clusterlens.functions.vectors import col_of, distance
from clusterlens.schema import CENTERS_SCHEMA, WEIGHTED_CENTERS_SCHEMA

# Centres beyond this many values are not collected at all: no k-means model
# of that size is meaningful, and the driver must not hold it.
MAX_CENTER_VALUES = 64 * 1024 * 1024
# Values per broadcast block; larger centre sets are split into blocks whose
# per-block winners are combined with a min over blocks.
BLOCK_VALUES = 4 * 1024 * 1024
# From so many centres on, balls of centres take less time than one product with
# all of them (README has the figures); the result is the same.
MANY_CENTERS = 512
# Working-set budgets for the numpy kernel (number of float64 entries): distances
# of a block of rows stay in a core's cache.
_CACHE_BUDGET = 64 * 1024
_EXACT_BUDGET = 8 * 1024 * 1024
# Up to so many centres the two nearest are found centre by centre.
FEW_CENTERS = 16

RESULT_TYPE = T.StructType([
    T.StructField("cluster", T.IntegerType(), True),
    T.StructField("dist", T.DoubleType(), True),
])


@dataclass(frozen=True)
class CenterSet:
    """Centres held on the driver: ids (sorted) and a (k, d) matrix."""

    ids: np.ndarray
    matrix: np.ndarray

    @property
    def k(self) -> int:
        return int(self.matrix.shape[0])

    def broadcasts(self, sc) -> list:
        """The blocks as broadcasts, made once for all uses of these centres."""
        held = self.__dict__.get("_held")
        if held is None or held[0] is not sc:
            held = (sc, [sc.broadcast(b) for b in _blocks(self)])
            object.__setattr__(self, "_held", held)
        return held[1]

    def release(self) -> None:
        """Drop the broadcasts; only after the last action that uses them."""
        held = self.__dict__.pop("_held", None)
        for b in held[1] if held else ():
            b.destroy()

    @property
    def dim(self) -> int:
        return int(self.matrix.shape[1])

    @classmethod
    def from_arrays(cls, ids, rows) -> "CenterSet":
        ids = np.asarray(ids, dtype=np.int64)
        mat = np.asarray(rows, dtype=np.float64)
        if mat.ndim != 2 or len(ids) != mat.shape[0]:
            raise ValueError("centres must be k rows of equal width")
        order = np.argsort(ids, kind="stable")
        return cls(ids[order], np.ascontiguousarray(mat[order]))

    @classmethod
    def from_df(cls, centers: DataFrame, cluster_col: str = "cluster",
                center_col: str = "center") -> "CenterSet":
        """Collect a ``(cluster, center)`` DataFrame after checking its size.

        The (small) centres are cached across the check and the collect, so
        centres derived from a large table are computed once.
        """
        c = centers.select(cluster_col, center_col).persist()
        try:
            stats = c.agg(F.count(F.lit(1)).alias("k"),
                          F.max(F.size(center_col)).alias("d"),
                          F.min(F.size(center_col)).alias("d0")).first()
            k, d, d0 = int(stats["k"]), stats["d"], stats["d0"]
            if k == 0:
                raise ValueError("no centres")
            if d != d0:
                raise ValueError(f"centres have unequal widths {d0}..{d}")
            if k * d > MAX_CENTER_VALUES:
                raise ValueError(
                    f"{k} centres x {d} dims exceed {MAX_CENTER_VALUES} values")
            rows = c.collect()
        finally:
            c.unpersist()
        return cls.from_arrays([r[0] for r in rows], [r[1] for r in rows])

    def to_df(self, spark, weights=None) -> DataFrame:
        rows = [(int(i), [float(v) for v in row])
                for i, row in zip(self.ids, self.matrix)]
        if weights is None:
            return spark.createDataFrame(rows, CENTERS_SCHEMA)
        return spark.createDataFrame([r + (float(w),) for r, w in zip(rows, weights)],
                                     WEIGHTED_CENTERS_SCHEMA)


def as_center_set(centers) -> CenterSet:
    if isinstance(centers, CenterSet):
        return centers
    if isinstance(centers, DataFrame):
        return CenterSet.from_df(centers)
    raise TypeError(f"cannot use {type(centers)!r} as centres")


# --------------------------------------------------------------------------
# numpy kernel (runs inside Python workers on Arrow batches)
# --------------------------------------------------------------------------

def _exact_argmin(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), dtype=np.int64)
    step = max(1, _EXACT_BUDGET // max(1, c.size))
    for s in range(0, len(x), step):
        diff = x[s:s + step, None, :] - c[None, :, :]
        out[s:s + step] = np.einsum("ikd,ikd->ik", diff, diff).argmin(axis=1)
    return out


def _two_least(d2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per column the first row with the least entry, and how far above it the
    second least is; a few operations per row of ``d2`` on all columns."""
    least, second = d2[0].copy(), np.full(d2.shape[1], np.inf)
    at = np.zeros(d2.shape[1], dtype=np.int64)
    for j in range(1, len(d2)):
        row = d2[j]
        np.minimum(second, np.maximum(row, least), out=second)
        np.copyto(at, j, where=row < least)
        np.minimum(least, row, out=least)
    return at, second - least


def nearest_numpy(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest row of ``c`` and the exact distance, per row of x."""
    m, k = x.shape[0], c.shape[0]
    best = np.empty(m, dtype=np.int64)
    cc = np.einsum("ij,ij->i", c, c)
    cmax = float(cc.max()) if k else 0.0
    few = 1 < k <= FEW_CENTERS
    step = max(1, _CACHE_BUDGET // max(1, k))
    # |c|^2 - 2 x.c as one product: x gets an entry of 1, c one of its squared norm
    turned = np.vstack((-2.0 * c.T, cc))
    wide = np.ones((min(step, m), c.shape[1] + 1))
    for s in range(0, m, step):
        xs = x[s:s + step]
        xx = np.einsum("ij,ij->i", xs, xs)
        if few:
            b, gap = _two_least(cc[:, None] - 2.0 * (c @ xs.T))
            amb = np.nonzero(~(gap > 1e-9 * (xx + cmax) + 1e-300))[0]
            if len(amb):
                b[amb] = _exact_argmin(xs[amb], c)
            best[s:s + step] = b
            continue
        # the squared norm of x is the same for every centre
        wide[:len(xs), :-1] = xs
        d2 = wide[:len(xs)] @ turned
        b = d2.argmin(axis=1)
        if k > 1:
            # error of the product form is ~ d * eps * (|x|^2 + |c|^2); where the
            # second least is not beyond a far wider margin, or no number, exact
            # differences decide
            line = np.arange(len(xs))
            margin = d2[line, b] + (1e-9 * (xx + cmax) + 1e-300)
            d2[line, b] = np.inf
            amb = np.nonzero(~(d2[line, d2.argmin(axis=1)] > margin))[0]
            if len(amb):
                b[amb] = _exact_argmin(xs[amb], c)
        best[s:s + step] = b
    diff = x - c[best]
    return best, np.sqrt(np.einsum("ij,ij->i", diff, diff))


def nearest_in_balls(x: np.ndarray, balls: CenterBalls) -> tuple[np.ndarray, np.ndarray]:
    """``nearest_numpy`` over balls of centres: the same index and distance."""
    best, unsure = balls.candidates(x)
    if len(unsure):
        best[unsure] = _exact_argmin(x[unsure], balls.c)
        balls.compared += len(unsure) * len(balls.c)
    diff = x - balls.c[best]
    return best, np.sqrt(np.einsum("ij,ij->i", diff, diff))


def kernel_of(c: np.ndarray, many: int | None = None):
    """Rows to (index of the nearest row of ``c``, distance), by the faster of
    the two; made once per task, as balls take a pass over the centres."""
    if len(c) < (MANY_CENTERS if many is None else many):
        return lambda x: nearest_numpy(x, c)
    balls = CenterBalls(c)
    return lambda x: nearest_in_balls(x, balls)


def _matrix_of(feats, d: int) -> tuple[np.ndarray, np.ndarray]:
    """The finite rows of width ``d`` as a matrix, and their positions."""
    if isinstance(feats, pa.ChunkedArray):
        feats = feats.combine_chunks()
    lengths = pc.list_value_length(feats)
    ok = pc.fill_null(pc.equal(lengths, d), False).to_numpy(zero_copy_only=False)
    sub = feats if ok.all() else feats.filter(pa.array(ok))
    x = sub.flatten().to_numpy(zero_copy_only=False)
    x = np.asarray(x, dtype=np.float64).reshape(len(sub), d)
    finite = np.isfinite(x).all(axis=1)
    return np.ascontiguousarray(x[finite]), np.nonzero(ok)[0][finite]


def _arrow_nearest(feats, ids: np.ndarray, d: int, kernel) -> pa.Array:
    x, rows = _matrix_of(feats, d)
    n = len(feats)
    cluster = np.zeros(n, dtype=np.int32)
    dist = np.zeros(n, dtype=np.float64)
    valid = np.zeros(n, dtype=bool)
    if len(rows):
        b, dd = kernel(x)
        cluster[rows] = ids[b].astype(np.int32)
        dist[rows] = dd
        valid[rows] = True
    mask = ~valid
    return pa.StructArray.from_arrays(
        [pa.array(cluster, mask=mask), pa.array(dist, mask=mask)],
        fields=[pa.field("cluster", pa.int32()), pa.field("dist", pa.float64())])


def _arrow_udf_for(block, many: int | None):
    from pyspark.sql.functions import arrow_udf

    @arrow_udf(RESULT_TYPE)
    def nearest_centre(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids, c = block.value
        kernel = kernel_of(c, many)
        for feats in batches:
            yield _arrow_nearest(feats, ids, c.shape[1], kernel)

    # Marked non-deterministic only so the optimizer evaluates it exactly
    # once per row: otherwise a filter on its output (e.g. cluster IS NOT
    # NULL) is pushed below the projection and the kernel runs twice.
    return nearest_centre.asNondeterministic()


def _blocks(centers: CenterSet):
    per_block = max(1, BLOCK_VALUES // max(1, centers.dim))
    for s in range(0, centers.k, per_block):
        yield centers.ids[s:s + per_block], centers.matrix[s:s + per_block]


def _min_struct(a: Column, b: Column) -> Column:
    """Earlier block wins ties, matching lowest-id-first."""
    return F.when(b["dist"].isNotNull() & (a["dist"].isNull() | (b["dist"] < a["dist"])),
                  b).otherwise(a)


def nearest_arrow(features: str | Column, centers: CenterSet, spark,
                  many: int | None = None) -> Column:
    """``many``: centres of a block from which on balls are used."""
    result = None
    for block in centers.broadcasts(spark.sparkContext):
        expr = _arrow_udf_for(block, many)(col_of(features))
        result = expr if result is None else _min_struct(result, expr)
    return result


def nearest_hof(features: str | Column, centers: CenterSet) -> Column:
    """Higher-order-function form of the same assignment."""
    f = col_of(features)
    lit_centers = F.array(*[
        F.struct(F.lit(int(i)).alias("cluster"),
                 F.array(*[F.lit(float(v)) for v in row]).alias("center"))
        for i, row in zip(centers.ids, centers.matrix)])
    init = F.struct(F.lit(None).cast("int").alias("cluster"),
                    F.lit(None).cast("double").alias("dist"))

    def step(acc, c):
        d = distance(f, c["center"])
        better = acc["dist"].isNull() | (d < acc["dist"])
        return F.when(better, F.struct(c["cluster"].alias("cluster"),
                                       d.alias("dist"))).otherwise(acc)

    ok = (F.size(f) == centers.dim) & ~F.exists(f, lambda v: v.isNull() | F.isnan(v))
    return F.when(ok, F.aggregate(lit_centers, init, step))


def assign(df: DataFrame, centers, features: str = "features",
           cluster_col: str = "cluster", dist_col: str = "dist",
           method: str = "arrow") -> DataFrame:
    """Add the nearest centre's id and the distance to it (X2 + X3).

    ``centers`` is a ``CenterSet`` or a ``(cluster, center)`` DataFrame.
    Rows whose features are null, of the wrong width or not finite get null
    in both columns.
    """
    cs = as_center_set(centers)
    if method == "arrow":
        expr = nearest_arrow(features, cs, df.sparkSession)
    elif method == "balls":
        expr = nearest_arrow(features, cs, df.sparkSession, many=1)
    elif method == "hof":
        expr = nearest_hof(features, cs)
    else:
        raise ValueError(f"unknown method {method!r}")
    tmp = "__nearest"
    return (df.withColumn(tmp, expr)
              .withColumn(cluster_col, F.col(f"{tmp}.cluster"))
              .withColumn(dist_col, F.col(f"{tmp}.dist"))
              .drop(tmp))


def distance_counts(df: DataFrame, centers, features: str = "features") -> DataFrame:
    """One row: rows assigned, distances that balls of centres take for them
    (pivots and exact decisions included) and rows times centres."""
    cs = as_center_set(centers)
    blocks, d = cs.broadcasts(df.sparkSession.sparkContext), cs.dim

    def count(batches):
        balls = [CenterBalls(b.value[1]) for b in blocks]
        n = 0
        for batch in batches:
            x, rows = _matrix_of(batch.column(0), d)
            n += len(rows)
            for b in balls:
                nearest_in_balls(x, b)
        yield pa.RecordBatch.from_pydict({"n": [n], "compared": [sum(b.compared for b in balls)]})

    counts = df.select(col_of(features)).mapInArrow(count, "n long, compared long")
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                      F.coalesce(F.sum("compared"), F.lit(0)).alias("n_compared"),
                      (F.coalesce(F.sum("n"), F.lit(0)) * cs.k).alias("n_pairs"))
