"""The streaming flow of the reference's main job (E2), wired per micro-batch.

For every micro-batch of record lines (one ``foreachBatch`` call):

* parse with the training parser (same dictionaries); malformed lines are
  written as ``quarantine/batch_id=N`` and counted in ``counts/batch_id=N``
  (total = parsed + quarantined);
* R1 + R2: streaming k-means update from the batch model, normalised with
  the frozen training moments, then the batch's distance score;
* R3: records the frozen batch detector flags, written as
  ``anomalies/batch_id=N``;
* R6: the cluster/label make-up of the batch under the updated model,
  written as report version N for the dashboard; and the running make-up of
  all batches so far (D8, sums), as a delta log (``running``).

Everything is keyed by the batch id and overwritten on replay, and the model
update is skipped for a committed batch, so at-least-once delivery of
micro-batches gives the same tables as exactly-once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.functions.nearest import assign
from clusterlens.operators import evaluate as ev
from clusterlens.operators import parse as ps
from clusterlens.operators.anomaly import AnomalyDetector
from clusterlens.streaming.delta_log import DeltaLog, summed
from clusterlens.streaming.kmeans_stream import StreamingKMeans
from clusterlens.streaming.score import read_latest_snapshot, write_snapshot


class StreamMonitor:
    def __init__(self, spark: SparkSession, root: str, parse: Callable[[DataFrame], DataFrame],
                 detector: AnomalyDetector, initial_weight: float = 100.0, decay: float = 1.0,
                 time_unit: str = "batches", keep: tuple[str, ...] = ("rid", "line")):
        self.spark, self.root, self.parse, self.detector = spark, root.rstrip("/"), parse, detector
        self.keep = keep
        self.model = StreamingKMeans(spark, f"{self.root}/model", detector.centers,
                                     initial_weight=initial_weight, decay=decay,
                                     time_unit=time_unit, normalizer=detector.normalizer)

    def process(self, lines: DataFrame, batch_id: int) -> None:
        # filters come after the cache: none is pushed back into the parse
        every = self.parse(lines).persist()
        try:
            bad = ps.quarantine(every).select(*self.keep)
            bad.write.mode("overwrite").parquet(f"{self.root}/quarantine/batch_id={batch_id}")
            ps.quarantine_counts(every).write.mode("overwrite").parquet(
                f"{self.root}/counts/batch_id={batch_id}")
            parsed = every.where(F.col("features").isNotNull())
            self.model.process(parsed, batch_id)
            flagged = self.detector.anomalies(parsed).select(*self.keep, "label", "cluster", "dist")
            flagged.write.mode("overwrite").parquet(f"{self.root}/anomalies/batch_id={batch_id}")
            _, cs, _ = self.model.latest()
            pts = parsed
            if self.detector.normalizer is not None:
                pts = self.detector.normalizer.apply(parsed)
            makeup = ev.label_makeup(assign(pts, cs))
            write_snapshot(makeup, f"{self.root}/report", batch_id)
            now = read_latest_snapshot(self.spark, f"{self.root}/report", makeup.schema)
            self.log(makeup).append(now, batch_id)
        finally:
            every.unpersist()

    def log(self, makeup: DataFrame) -> DeltaLog:
        """The running make-up of all batches, as deltas of the make-up's schema."""
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in makeup.schema)
        return DeltaLog(self.spark, f"{self.root}/running", schema, summed(("cluster", "label")))

    def running(self) -> DataFrame:
        """``cluster, label, count`` over all batches so far."""
        return self.log(self.spark.createDataFrame([], "cluster int, label string, count long")).state()

    def anomalies(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/anomalies")

    def quarantined(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/quarantine")

    def counts(self) -> DataFrame:
        """``batch_id, parsed, quarantined, total`` per processed batch."""
        return self.spark.read.parquet(f"{self.root}/counts")

    def metrics(self) -> DataFrame:
        return self.model.metrics()

    def start(self, lines_stream: DataFrame, checkpoint: str, trigger: dict | None = None):
        self.model.ensure_initial()
        w = (lines_stream.writeStream.foreachBatch(self.process)
             .option("checkpointLocation", checkpoint)
             .trigger(**(trigger or {"processingTime": "10 seconds"})))
        return w.start()
