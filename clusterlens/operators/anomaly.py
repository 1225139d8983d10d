"""Distance threshold and anomaly flags.

The threshold is the n-th largest distance to the nearest centre. It is a
top-n (``TakeOrderedAndProject``): each partition keeps its n largest
distances and one task merges n x partitions values, bounded by n, not by
the data. Records are anomalous when strictly farther than the threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clusterlens import defaults as D
from clusterlens.functions.nearest import CenterSet, as_center_set, assign
from clusterlens.operators.stats import Normalizer


def distance_threshold(scored: DataFrame, n: int = D.ANOMALY_TOP_N,
                       dist_col: str = "dist", weight_col: str | None = None) -> DataFrame:
    """One row ``threshold`` = n-th largest distance.

    With fewer than n rows it is the smallest distance (as the reference's
    ``top(n).last``); with no rows it is null. ``weight_col`` says how many
    records a row stands for (one or more).
    """
    top = (scored.where(F.col(dist_col).isNotNull())
                 .select(dist_col, *([weight_col] if weight_col else []))
                 .orderBy(F.desc(dist_col)).limit(n))
    if weight_col:
        # n rows at most: those before which fewer than n records come
        before = F.sum(weight_col).over(Window.orderBy(F.desc(dist_col)).rowsBetween(
            Window.unboundedPreceding, -1))
        top = top.withColumn("_before", before).where(F.coalesce("_before", F.lit(0)) < n)
    return top.agg(F.min(dist_col).alias("threshold"))


def threshold_value(scored: DataFrame, n: int = D.ANOMALY_TOP_N,
                    dist_col: str = "dist") -> Column:
    """The threshold as a scalar subquery (stays inside one plan)."""
    return distance_threshold(scored, n, dist_col).scalar()


def flag(scored: DataFrame, threshold, dist_col: str = "dist",
         out: str = "anomalous") -> DataFrame:
    """``dist > threshold`` (strict); a null threshold flags nothing."""
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return scored.withColumn(out, F.coalesce(F.col(dist_col) > t, F.lit(False)))


@dataclass(frozen=True)
class AnomalyDetector:
    """Normaliser + centres + threshold, all O(k*d) driver values."""

    normalizer: Normalizer | None
    centers: CenterSet
    threshold: float | None

    @classmethod
    def build(cls, points: DataFrame, centers, normalizer: Normalizer | None = None,
              n: int = D.ANOMALY_TOP_N, features: str = "features",
              centers_normalized: bool = True) -> "AnomalyDetector":
        """Threshold = n-th largest distance of ``points`` under the model.

        ``centers`` live in the normalised space when ``centers_normalized``
        (a model fitted on normalised data); otherwise they are normalised
        here with the same normaliser.
        """
        cs = centers
        if normalizer is not None and not centers_normalized:
            cs = normalizer.apply_to_centers(centers)
        cs = as_center_set(cs)
        pts = normalizer.apply(points, features) if normalizer else points
        t = distance_threshold(assign(pts, cs, features), n).first()["threshold"]
        return cls(normalizer, cs, t)

    def score(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Normalised features, nearest cluster, distance and the flag."""
        pts = self.normalizer.apply(df, features) if self.normalizer else df
        return flag(assign(pts, self.centers, features), self.threshold)

    def anomalies(self, df: DataFrame, features: str = "features") -> DataFrame:
        return self.score(df, features).where(F.col("anomalous"))


def build_detector_selffit(points: DataFrame, k: int = D.DETECTOR_K, runs: int = D.BATCH_RUNS,
                           tol: float = D.BATCH_EPSILON, n: int = D.ANOMALY_TOP_N, seed: int = 1,
                           features: str = "features",
                           max_iter: int = 20, id_col: str | None = None) -> AnomalyDetector:
    """Normalise, fit the best of ``runs`` k-means models, then N1.

    Fit and threshold share the distinct vectors and their numbers of records,
    so the records are read twice: for the moments and for these."""
    from clusterlens.operators.kmeans import fit_weighted
    from clusterlens.operators.kmeans_runs import distances, packed, weighted_points

    nz = Normalizer.fit(points, features)
    vec = packed(weighted_points(nz.apply(points, features), features, id_col)).persist()
    try:
        model = fit_weighted(vec, k=k, runs=runs, tol=tol, seed=seed, max_iter=max_iter)
        t = distance_threshold(distances(vec, model.centers.matrix), n, weight_col="w").first()["threshold"]
    finally:
        vec.unpersist()
    return AnomalyDetector(nz, model.centers, t)
