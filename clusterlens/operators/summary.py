"""One reading of the scored records for make-up and threshold together.

A record beyond the n-th largest distance is among the n largest, so a task that
keeps its n largest distances beside its counts per (cluster, label) has seen
all it needs to: the partial tables are merged by one aggregate, and threshold
and anomalies follow from them. The records, and the nearest-centre kernel that
scores them, are read once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterlens import defaults as D
from clusterlens.functions.vectors import col_of


def summarise(assigned: DataFrame, n: int = D.ANOMALY_TOP_N, cluster_col: str = "cluster",
              label_col: str = "label", dist_col: str = "dist") -> DataFrame:
    """``cluster, label, count, sum_dist, top``: per group its size, its sum of
    distances and, in falling order, those of its distances that may be among the
    n largest of all. Records without a cluster are left out.

    The arrays of all groups together hold at most n numbers a task.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    names = [cluster_col, label_col, "count", "sum_dist", "top"]
    kinds = [assigned.schema[c].dataType.simpleString() for c in (cluster_col, label_col)]
    schema = (f"`{cluster_col}` {kinds[0]}, `{label_col}` {kinds[1]}, count bigint, "
              "sum_dist double, top array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, int] = {}
        count, total = np.zeros(0, np.int64), np.zeros(0)
        top, owner, types = np.zeros(0), np.zeros(0, np.int64), None
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(0)))
            if not batch.num_rows:
                continue
            types = [batch.column(i).type for i in (0, 1)]
            codes, values = [], []
            for i in (0, 1):
                c = batch.column(i).dictionary_encode()
                values.append(c.dictionary.to_pylist() + [None])
                codes.append(c.indices.fill_null(len(c.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64))
            pair, local = np.unique(codes[0] * len(values[1]) + codes[1], return_inverse=True)
            index = np.array([groups.setdefault((values[0][p // len(values[1])], values[1][p % len(values[1])]),
                                                len(groups)) for p in pair.tolist()])[local]
            dist = batch.column(2).to_numpy(zero_copy_only=False)
            grown = len(groups) - len(count)
            count = np.append(count, np.zeros(grown, np.int64)) + np.bincount(index, minlength=len(groups))
            total = np.append(total, np.zeros(grown)) + np.bincount(
                index, weights=np.nan_to_num(dist), minlength=len(groups))
            live = ~np.isnan(dist)
            top, owner = np.append(top, dist[live]), np.append(owner, index[live])
            if len(top) > n:
                kept = np.argpartition(-top, n - 1)[:n]
                top, owner = top[kept], owner[kept]
        if groups:
            mine = [np.sort(top[owner == g])[::-1].tolist() for g in range(len(groups))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in groups], types[0]), pa.array([g[1] for g in groups], types[1]),
                 pa.array(count), pa.array(total), pa.array(mine, pa.list_(pa.float64()))], names)

    parts = assigned.select(cluster_col, label_col, col_of(dist_col).cast("double").alias("dist"))
    return (parts.mapInArrow(run, schema).groupBy(cluster_col, label_col)
            .agg(F.sum("count").alias("count"), F.sum("sum_dist").alias("sum_dist"),
                 F.slice(F.sort_array(F.flatten(F.collect_list("top")), asc=False), 1, n).alias("top")))


def threshold_of(summary: DataFrame, n: int = D.ANOMALY_TOP_N) -> DataFrame:
    """T1 from a summary: one row ``threshold``, the n-th largest distance."""
    return (summary.select(F.explode("top").alias("d")).orderBy(F.desc("d")).limit(n)
            .agg(F.min("d").alias("threshold")))


def beyond(threshold: Column, top: str | Column = "top") -> Column:
    """How many of a group's distances lie beyond the threshold."""
    return F.coalesce(F.size(F.filter(col_of(top), lambda d: d > threshold)), F.lit(0)).cast("bigint")


def anomaly_count_of(assigned: DataFrame, n: int = D.ANOMALY_TOP_N, dist_col: str = "dist") -> DataFrame:
    """A7 in one plan that reads the records once: ``anomalies``, the records
    strictly beyond the n-th largest distance, all of them among the n largest."""
    d = col_of(dist_col)
    top = assigned.where(d.isNotNull()).select(d.alias("d")).orderBy(F.desc("d")).limit(n)
    held = top.agg(F.min("d").alias("t"), F.collect_list("d").alias("ds"))
    return held.select(F.size(F.filter("ds", lambda x: x > F.col("t"))).cast("bigint").alias("anomalies"))
