"""k-means: default and tuned fits, Lloyd steps from given centres, k sweeps.

Fits are batches of runs (``kmeans_runs``): seeding and Lloyd iterations of all
runs, and of all k of a sweep, share their passes over the points. Lloyd steps
from *given* centres are plain DataFrame jobs: nearest centre, then a
per-cluster vector sum that is combined map-side, so only k x d partial sums per
partition are shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from clusterlens import defaults as D
from clusterlens.functions.nearest import CenterSet, as_center_set, assign
from clusterlens.functions.vectors import UNROLL_LIMIT, col_of, of_width
from clusterlens.operators import evaluate as ev
from clusterlens.operators import kmeans_runs as kr


@dataclass(frozen=True)
class KMeansResult:
    centers: CenterSet
    cost: float
    k: int
    seed: int

    def centers_df(self, spark) -> DataFrame:
        return self.centers.to_df(spark)


def _result(fitted: kr.Fitted) -> KMeansResult:
    return KMeansResult(CenterSet.from_arrays(range(len(fitted.centers)), fitted.centers),
                        fitted.cost, fitted.run.k, fitted.run.seed)


def fit(points: DataFrame, k: int = D.DEFAULT_K, seed: int = 1, tol: float = 1e-4,
        max_iter: int = 20, init_steps: int = 2, features: str = "features",
        id_col: str | None = None) -> KMeansResult:
    """K1: one k-means fit (defaults: k = 2, tolerance 1e-4, 20 iterations)."""
    return fit_best(points, k, 1, tol, seed, max_iter, init_steps, features, id_col)


def fit_best(points: DataFrame, k: int, runs: int = D.BATCH_RUNS, tol: float = D.BATCH_EPSILON,
             seed: int = 1, max_iter: int = 20, init_steps: int = 5, features: str = "features",
             id_col: str | None = None) -> KMeansResult:
    """K2: best (lowest cost) of ``runs`` fits with seeds seed..seed+runs-1.

    All runs share each pass over the distinct points, which are persisted; the
    number of jobs is that of the slowest run. ``id_col`` names the rows for the
    random draws (a vector that occurs often goes by its least id); without it
    the vector itself does.
    """
    vec = kr.packed(kr.weighted_points(points, features, id_col)).persist()
    try:
        return fit_weighted(vec, k, runs, tol, seed, max_iter, init_steps)
    finally:
        vec.unpersist()


def fit_weighted(vec: DataFrame, k: int, runs: int = D.BATCH_RUNS, tol: float = D.BATCH_EPSILON,
                 seed: int = 1, max_iter: int = 20, init_steps: int = 5) -> KMeansResult:
    """K2 over ``kmeans_runs.packed`` points that the caller has persisted."""
    return _result(kr.best_of(kr.fit_runs(vec, [kr.Run(k, seed + r) for r in range(runs)],
                                          tol, max_iter, init_steps)))


def vector_sums(assigned: DataFrame, dim: int, features: str = "features",
                cluster_col: str = "cluster") -> DataFrame:
    """``cluster, n, sums`` with the element-wise sum of each cluster's vectors."""
    f = col_of(features)
    live = assigned.where(F.col(cluster_col).isNotNull())
    if dim <= UNROLL_LIMIT:
        agg = live.groupBy(cluster_col).agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(F.get(f, i)).alias(f"s{i}") for i in range(dim)])
        return agg.select(cluster_col, "n",
                          F.array(*[F.col(f"s{i}") for i in range(dim)]).alias("sums"))
    per = (live.select(cluster_col, F.posexplode_outer(f).alias("pos", "x"))
               .where(F.col("pos").isNotNull())
               .groupBy(cluster_col, "pos").agg(F.sum("x").alias("s"),
                                                F.count(F.lit(1)).alias("n")))
    return (per.groupBy(cluster_col)
               .agg(F.max("n").alias("n"),
                    F.array_sort(F.collect_list(F.struct("pos", "s"))).alias("_ps"))
               .select(cluster_col, "n", F.transform("_ps", lambda x: x["s"]).alias("sums")))


def group_means(points: DataFrame, group_col: str = "label", dim: int | None = None,
                features: str = "features") -> DataFrame:
    """``cluster, center``: the mean vector of each group (e.g. one centre per
    label, a nearest-centroid model). One map-side-combined aggregate.

    Integer groups keep their number; string groups are numbered in their
    order and kept as a third column. A vector of another width than ``dim``
    stops the job."""
    if dim is None:
        from clusterlens.operators.stats import vector_width
        dim = vector_width(points, features)
    live = points.where(F.col(group_col).isNotNull()).withColumn(
        features, of_width(features, dim))
    sums = vector_sums(live, dim, features, cluster_col=group_col)
    center = F.transform("sums", lambda v: v / F.col("n")).alias("center")
    if isinstance(points.schema[group_col].dataType, StringType):
        from clusterlens.operators.ordering import positions
        numbered = positions(sums, [F.col(group_col)], "cluster")
        return numbered.select(F.col("cluster").cast("int").alias("cluster"), center,
                               F.col(group_col))
    return sums.select(F.col(group_col).cast("int").alias("cluster"), center)


def lloyd(points: DataFrame, centers, steps: int = 1,
          features: str = "features") -> CenterSet:
    """K9: ``steps`` Lloyd iterations from the given centres.

    A cluster that receives no point keeps its centre. ``points`` should be
    persisted by the caller when ``steps`` > 1.
    """
    cs = given = as_center_set(centers)
    index = {int(c): i for i, c in enumerate(cs.ids)}
    for _ in range(steps):
        rows = vector_sums(assign(points, cs, features), cs.dim, features).collect()
        mat = cs.matrix.copy()
        for r in rows:
            mat[index[int(r["cluster"])]] = np.asarray(r["sums"], dtype=np.float64) / r["n"]
        if cs is not given:
            cs.release()
        cs = CenterSet(cs.ids, mat)
    return cs


def score(points: DataFrame, centers, how: str = "distance",
          features: str = "features", label_col: str = "label") -> float:
    """Distance score (A3) or weighted entropy (A6) of a model on points."""
    a = assign(points, centers, features)
    if how == "distance":
        return float(ev.distance_score(a).first()["distance_score"])
    if how == "entropy":
        return float(ev.entropy_score(ev.label_makeup(a, label_col=label_col))
                     .first()["entropy_score"])
    raise ValueError(how)


def basic_score(points: DataFrame, k: int, seed: int = 1,
                features: str = "features") -> float:
    """K3: default fit for k, then its mean distance to the nearest centre."""
    return score(points, fit(points, k=k, seed=seed, features=features).centers,
                 "distance", features)


def tuned_score(points: DataFrame, k: int, runs: int = 10, tol: float = 1e-6,
                seed: int = 1, how: str = "distance",
                features: str = "features") -> float:
    """K4 (distance) / K8 scorer (entropy): tuned fit for k, then its score."""
    model = fit_best(points, k, runs=runs, tol=tol, seed=seed, features=features)
    return score(points, model.centers, how, features)


def k_sweep(points: DataFrame, ks, how: str = "distance", tuned: bool = True,
            runs: int = 10, tol: float = 1e-6, seed: int = 1,
            features: str = "features", id_col: str | None = None) -> DataFrame:
    """K3-K8: ``(k, score)`` for every k, in passes shared by all k.

    Every run of every k is in one batch, so the number of passes is that of the
    slowest run. Distance scores come from the last pass; for entropy the best
    model of each k is put to one more reading, with a make-up per k.
    """
    if how not in ("distance", "entropy"):
        raise ValueError(how)
    ks = list(dict.fromkeys(int(k) for k in ks))
    specs = [kr.Run(k, seed + r) for k in ks for r in range(runs if tuned else 1)]
    vec = kr.packed(kr.weighted_points(points, features, id_col)).persist()
    try:
        fits = kr.fit_runs(vec, specs, tol if tuned else 1e-4, 20, 5 if tuned else 2)
    finally:
        vec.unpersist()
    best = {k: kr.best_of([f for f in fits if f.run.k == k]) for k in ks}
    if how == "distance":
        return points.sparkSession.createDataFrame(
            [(k, float(best[k].mean_distance)) for k in ks], "k int, score double")
    makeup = kr.makeups(points, {k: best[k].centers for k in ks}, features)
    return ev.entropy_score(makeup, by="k").select("k", F.col("entropy_score").alias("score"))
