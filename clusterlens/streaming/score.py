"""Stateless stream scoring, event-time window scores and report snapshots
(S3, R3, R4, R5, R6).

The same functions work on a batch or a streaming DataFrame: scoring is a
per-row expression (nearest centre against broadcast centres), so the
streamed result equals the batch result on the union of the inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterlens.functions.nearest import assign
from clusterlens.operators.anomaly import AnomalyDetector
from clusterlens.session import path_exists


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """S3: a stream of records arriving as files (parquet, csv, text, json).

    A socket or Kafka source plugs in the same way: every operator below
    takes any streaming DataFrame.
    """
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def anomalies(df: DataFrame, detector: AnomalyDetector, features: str = "features") -> DataFrame:
    """Records the frozen batch detector flags (stateless)."""
    return detector.anomalies(df, features)


def predict(df: DataFrame, centers, features: str = "features") -> DataFrame:
    """Nearest cluster and distance for each record (stateless)."""
    return assign(df, centers, features)


def window_scores(scored: DataFrame, time_col: str = "ts", duration: str = "1 hour",
                  watermark: str | None = None, dist_col: str = "dist") -> DataFrame:
    """Per event-time tumbling window: record count and mean distance.

    On a stream pass ``watermark`` so the window state is bounded and closed
    windows are emitted in append mode. The time column must then be a
    TIMESTAMP (cast a TIMESTAMP_NTZ column first, see ``as_event_time``).
    """
    df = scored.withWatermark(time_col, watermark) if watermark else scored
    w = F.window(time_col, duration)
    return (df.groupBy(w.alias("window"))
              .agg(F.count(F.lit(1)).alias("n"), F.avg(dist_col).alias("mean_dist"))
              .select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                      "n", "mean_dist"))


def as_event_time(df: DataFrame, time_col: str = "ts") -> DataFrame:
    """Cast a TIMESTAMP_NTZ column to TIMESTAMP (session time zone)."""
    return df.withColumn(time_col, F.col(time_col).cast("timestamp"))


# ------------------------------------------------------------------ R6

def write_snapshot(report: DataFrame, root: str, version: int) -> str:
    """Write one report version as JSON (``root/v=<version>``).

    The version is then entered into the table ``root.versions``; readers only
    see entered versions, so a dashboard polling the folder never reads a
    half-written snapshot, and an empty report is a version like any other.
    """
    path = f"{root.rstrip('/')}/v={int(version)}"
    report.write.mode("overwrite").json(path)
    spark = report.sparkSession
    spark.createDataFrame([(int(version),)], "version long").write.mode("overwrite").parquet(
        f"{root.rstrip('/')}.versions/v={int(version)}")
    return path


def read_latest_snapshot(spark: SparkSession, root: str, schema: T.StructType,
                         before: int | None = None) -> DataFrame:
    """The most recent entered report version (below ``before`` when given)."""
    root = root.rstrip("/")
    v = None
    if path_exists(spark, f"{root}.versions"):
        known = spark.read.schema("version long").parquet(f"{root}.versions/*")
        if before is not None:
            known = known.where(F.col("version") < before)
        v = known.agg(F.max("version")).first()[0]
    if v is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{root}/v={v}")


def snapshot_writer(report_fn, root: str):
    """``foreachBatch`` function: ``report_fn(batch_df) -> report`` written
    as version ``batch_id``; a replayed batch overwrites the same version."""

    def run(batch: DataFrame, batch_id: int) -> None:
        write_snapshot(report_fn(batch), root, batch_id)

    return run
