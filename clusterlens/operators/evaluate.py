"""Clustering scores over an assigned DataFrame (``cluster``, ``dist``, label).

All of them are algebraic aggregates (count, sum), so Spark combines them
map-side before the shuffle: a cluster or label holding a third of all rows
costs one partial-aggregate entry per partition, never a hot task. Nothing
collects the members of a group (the reference's ``groupByKey`` did).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterlens import defaults as D
from clusterlens.operators.ordering import positions


def label_makeup(assigned: DataFrame, cluster_col: str = "cluster",
                 label_col: str = "label") -> DataFrame:
    """A4: number of records per (cluster, label)."""
    return (assigned.where(F.col(cluster_col).isNotNull())
            .groupBy(cluster_col, label_col)
            .agg(F.count(F.lit(1)).alias("count")))


def makeup_text(makeup: DataFrame, cluster_col: str = "cluster",
                label_col: str = "label") -> DataFrame:
    """The fixed-width text line ``cluster%1s label%18s count%8s``."""
    return makeup.select(
        cluster_col, label_col, "count",
        F.format_string(D.MAKEUP_LINE_FORMAT, F.col(cluster_col).cast("string"),
                        F.col(label_col).cast("string"),
                        F.col("count").cast("string")).alias("line"))


def distance_score(assigned: DataFrame, dist_col: str = "dist") -> DataFrame:
    """A3: mean distance to the nearest centre (one row: n, score)."""
    d = F.col(dist_col)
    return assigned.where(d.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.avg(d).alias("distance_score"))


def distance_by_cluster(assigned: DataFrame, cluster_col: str = "cluster",
                        dist_col: str = "dist") -> DataFrame:
    """A3 per cluster: size and mean distance of each cluster."""
    return (assigned.where(F.col(cluster_col).isNotNull())
            .groupBy(cluster_col)
            .agg(F.count(F.lit(1)).alias("n"),
                 F.avg(dist_col).alias("mean_dist")))


def _cluster_sums(makeup: DataFrame, cluster_col: str, count_col: str, *by: str) -> DataFrame:
    # H = ln t - (sum n ln n) / t  with t = sum n, over counts n > 0 (F2).
    n = F.col(count_col).cast("double")
    return (makeup.where(F.col(count_col) > 0)
            .groupBy(*by, cluster_col)
            .agg(F.sum(count_col).alias("n"),
                 F.sum(n * F.log(n)).alias("_nlogn"),
                 F.max(count_col).alias("_most")))


def cluster_entropy(makeup: DataFrame, cluster_col: str = "cluster",
                    count_col: str = "count", by: str | None = None) -> DataFrame:
    """A5: label entropy of each cluster, natural log: ``-sum p ln p``; with
    ``by``, of each cluster of each model."""
    models = (by,) if by else ()
    s = _cluster_sums(makeup, cluster_col, count_col, *models)
    t = F.col("n").cast("double")
    # rounding must not take a pure cluster off 0, nor any below it
    h = F.greatest(F.log(t) - F.col("_nlogn") / t, F.lit(0.0))
    return s.select(*models, cluster_col, "n",
                    F.when(F.col("_most") == F.col("n"), 0.0).otherwise(h).alias("entropy"))


def sorted_makeup(makeup: DataFrame, cluster_col: str = "cluster",
                  label_col: str = "label") -> DataFrame:
    """The make-up with ``pos``, its place in (cluster, label) order."""
    return positions(makeup, [F.col(cluster_col), F.col(label_col)], "pos")


def entropy_score(makeup: DataFrame, cluster_col: str = "cluster",
                  count_col: str = "count", by: str | None = None) -> DataFrame:
    """Size-weighted mean entropy ``sum n_c H_c / N`` (one row, or one for
    each model ``by`` tells apart)."""
    e = cluster_entropy(makeup, cluster_col, count_col, by)
    return e.groupBy(*((by,) if by else ())).agg(F.sum("n").alias("n"),
                 (F.sum(F.col("n") * F.col("entropy")) / F.sum("n"))
                 .alias("entropy_score"))


def anomaly_count(flagged: DataFrame, flag_col: str = "anomalous") -> DataFrame:
    """Number of flagged records (one row)."""
    return flagged.agg(
        F.count(F.when(F.col(flag_col), F.lit(1))).alias("anomalies"))
