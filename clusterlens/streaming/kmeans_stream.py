"""Streaming k-means on Structured Streaming.

Each micro-batch (``foreachBatch``):

1. skips the batch if its model version is already committed (a replayed
   batch id changes nothing: ``foreachBatch`` is at-least-once);
2. on executors: nearest centre + per-cluster count and vector sum
   (combined map-side; only k x d partial sums are shuffled);
3. on the driver, on those k rows: the forgetful update
   ``c' = (c * w * a + s) / (w * a + m)``, ``w' = w * a + m`` with
   ``a = decay`` per batch or ``decay ** points`` per point, and the split of
   a dying cluster (weight below 1e-8 of the largest);
4. scores the batch with the updated model (``score_first=True`` scores with
   the model before the update) and writes the metrics row;
5. commits the new centres as version ``batch_id`` (the commit point).

State lives in the shared checkpoint folder: ``centers/batch_id=N`` and
``metrics/batch_id=N``. A restarted query resumes from the largest
committed version.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens import defaults as D
from clusterlens.functions.nearest import CenterSet, as_center_set, assign
from clusterlens.operators.kmeans import vector_sums
from clusterlens.operators.stats import Normalizer
from clusterlens.session import path_exists

INITIAL_VERSION = -1


def update_model(centers: np.ndarray, weights: np.ndarray, counts: np.ndarray,
                 sums: np.ndarray, decay: float = 1.0,
                 time_unit: str = "batches") -> tuple[np.ndarray, np.ndarray]:
    """One forgetful k-means update from per-cluster counts and vector sums."""
    c = np.array(centers, dtype=np.float64, copy=True)
    w = np.array(weights, dtype=np.float64, copy=True)
    counts = np.asarray(counts, dtype=np.float64)
    if time_unit == "batches":
        discount = decay
    elif time_unit == "points":
        discount = decay ** counts.sum()
    else:
        raise ValueError("time_unit must be 'batches' or 'points'")
    w *= discount
    for j in np.nonzero(counts > 0)[0]:
        m = counts[j]
        lam = m / max(w[j] + m, 1e-16)
        w[j] += m
        c[j] = c[j] * (1.0 - lam) + (sums[j] / m) * lam
    big, small = int(np.argmax(w)), int(np.argmin(w))
    if len(w) > 1 and w[small] < 1e-8 * w[big]:
        half = (w[big] + w[small]) / 2.0
        w[big] = w[small] = half
        p = 1e-14 * np.maximum(np.abs(c[big]), 1.0)
        base = c[big].copy()
        c[big] = base + p
        c[small] = base - p
    return c, w


class StreamingKMeans:
    """R1 + R2 as a ``foreachBatch`` function with versioned state."""

    def __init__(self, spark: SparkSession, state_dir: str, initial_centers,
                 initial_weight: float | list[float] = D.STREAM_INITIAL_WEIGHT,
                 decay: float = D.STREAM_DECAY,
                 time_unit: str = "batches", normalizer: Normalizer | None = None,
                 features: str = "features", score_first: bool = False):
        self.spark = spark
        self.state_dir = state_dir.rstrip("/")
        cs = as_center_set(initial_centers)
        w = np.full(cs.k, float(initial_weight)) if np.isscalar(initial_weight) \
            else np.asarray(initial_weight, dtype=np.float64)
        if len(w) != cs.k:
            raise ValueError(f"{len(w)} weights for {cs.k} centres")
        self.initial = (cs, w)
        self.decay, self.time_unit = decay, time_unit
        self.normalizer, self.features, self.score_first = normalizer, features, score_first
        self._latest: tuple[int, CenterSet, np.ndarray] | None = None

    # ---- state table
    def _centers_path(self, v: int) -> str:
        return f"{self.state_dir}/centers/batch_id={v}"

    def _metrics_path(self, v: int) -> str:
        return f"{self.state_dir}/metrics/batch_id={v}"

    def committed(self, v: int) -> bool:
        return path_exists(self.spark, self._centers_path(v) + "/_SUCCESS")

    def _write_centers(self, v: int, cs: CenterSet, w: np.ndarray) -> None:
        cs.to_df(self.spark, weights=w).coalesce(1).write.mode("overwrite").parquet(
            self._centers_path(v))

    def ensure_initial(self) -> None:
        """Commit the initial model as version -1 unless a state exists."""
        if not self.committed(INITIAL_VERSION):
            cs, w = self.initial
            self._write_centers(INITIAL_VERSION, cs, w)
            if self._latest is None:  # fresh state: nothing newer can exist
                self._latest = (INITIAL_VERSION, cs, w)

    def latest(self, before: int | None = None) -> tuple[int, CenterSet, np.ndarray]:
        """Largest committed version (below ``before`` when given)."""
        if self._latest is not None and (before is None or self._latest[0] < before):
            return self._latest
        self.ensure_initial()
        allv = self.spark.read.parquet(f"{self.state_dir}/centers")
        if before is not None:
            allv = allv.where(F.col("batch_id") < before)
        v = allv.agg(F.max("batch_id")).first()[0]
        rows = allv.where(F.col("batch_id") == v).select("cluster", "center", "weight").collect()
        rows.sort(key=lambda r: r["cluster"])
        cs = CenterSet.from_arrays([r["cluster"] for r in rows], [r["center"] for r in rows])
        w = np.array([r["weight"] for r in rows], dtype=np.float64)
        self._latest = (int(v), cs, w)
        return self._latest

    def centers(self) -> DataFrame:
        """The current model: ``cluster, center, weight``."""
        _, cs, w = self.latest()
        return cs.to_df(self.spark, weights=w)

    def metrics(self) -> DataFrame:
        """R2 rows: ``batch_id, n, distance_score`` per processed batch."""
        return self.spark.read.parquet(f"{self.state_dir}/metrics")

    # ---- one micro-batch
    def process(self, batch: DataFrame, batch_id: int) -> None:
        if self.committed(batch_id):
            return
        _, cs, w = self.latest(before=batch_id)
        f = self.features
        pts = batch.select(f)
        if self.normalizer is not None:
            pts = self.normalizer.apply(pts, f)
        pts = pts.persist()
        try:
            before = self._score(pts, cs) if self.score_first else None
            stats = vector_sums(assign(pts, cs, f), cs.dim, f).collect()
            index = {int(c): i for i, c in enumerate(cs.ids)}
            counts = np.zeros(cs.k)
            sums = np.zeros((cs.k, cs.dim))
            for r in stats:
                i = index[int(r["cluster"])]
                counts[i] = r["n"]
                sums[i] = np.asarray(r["sums"], dtype=np.float64)
            c2, w2 = update_model(cs.matrix, w, counts, sums, self.decay, self.time_unit)
            new = CenterSet(cs.ids, c2)
            n, score = before if before is not None else self._score(pts, new)
        finally:
            pts.unpersist()
        self.spark.createDataFrame(
            [(int(batch_id), int(n), score)],
            "batch_id long, n long, distance_score double").write.mode("overwrite").parquet(
                self._metrics_path(batch_id))
        self._write_centers(batch_id, new, w2)
        self._latest = (int(batch_id), new, w2)
        if cs is not self.initial[0]:
            cs.release()        # no later batch uses the model before this one

    def _score(self, pts: DataFrame, cs: CenterSet) -> tuple[int, float | None]:
        r = assign(pts, cs, self.features).agg(F.count("dist").alias("n"),
                                                F.avg("dist").alias("s")).first()
        return int(r["n"]), (float(r["s"]) if r["s"] is not None else None)

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None):
        """Run on a streaming DataFrame; returns the ``StreamingQuery``."""
        self.ensure_initial()
        w = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        w = w.trigger(**(trigger or {"processingTime": f"{D.STREAM_BATCH_SECONDS} seconds"}))
        return w.start()
