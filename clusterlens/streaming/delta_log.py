"""Running tables kept as a log of per-batch deltas with compaction.

A micro-batch appends its own delta, so what is written per batch follows the
batch and not the table. Every ``every`` batches the log is folded into a base;
a reader merges the latest base with the deltas after it. A delta or base counts
only once it is entered in the table ``entries``; a replayed batch overwrites
its delta and enters it again, which changes nothing. Everything lies in shared
storage and nothing is deleted, so the state before any batch can be read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.functions.vectors import col_of
from clusterlens.session import path_exists


class DeltaLog:
    """``merge`` folds rows of the log's schema into rows of the same schema; it
    must not depend on their order or grouping."""

    def __init__(self, spark: SparkSession, root: str, schema: str,
                 merge: Callable[[DataFrame], DataFrame], every: int = 16):
        if every < 1:
            raise ValueError("every must be at least 1")
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.merge, self.every = merge, every

    def _path(self, kind: str, version: int) -> str:
        return f"{self.root}/{kind}/v={int(version)}"

    def _write(self, kind: str, version: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(self._path(kind, version))
        self.spark.createDataFrame([(kind, int(version))], "kind string, version long").write.mode(
            "overwrite").parquet(f"{self.root}/entries/{kind}-{int(version)}")

    def versions(self, kind: str = "delta", before: int | None = None) -> list[int]:
        """Entered versions in order, those below ``before`` if it is given."""
        if not path_exists(self.spark, f"{self.root}/entries"):
            return []
        rows = (self.spark.read.schema("kind string, version long").parquet(f"{self.root}/entries/*")
                .where(F.col("kind") == kind))
        if before is not None:
            rows = rows.where(F.col("version") < before)
        return sorted(r["version"] for r in rows.select("version").distinct().collect())

    def append(self, delta: DataFrame, batch_id: int) -> None:
        self._write("delta", batch_id, self.merge(delta))
        if (batch_id + 1) % self.every == 0:
            # a replay writes its base anew, so it must not read it
            self._write("base", batch_id, self.state(batch_id + 1, batch_id))

    def state(self, before: int | None = None, base_before: int | None = None) -> DataFrame:
        """All deltas (of batches below ``before``) merged; bases below
        ``base_before`` only, if it is given."""
        bases = self.versions("base", before if base_before is None else base_before)
        after = [v for v in self.versions("delta", before) if not bases or v > bases[-1]]
        paths = [self._path("base", bases[-1])] if bases else []
        paths += [self._path("delta", v) for v in after]
        if not paths:
            return self.merge(self.spark.createDataFrame([], self.schema))
        return self.merge(self.spark.read.schema(self.schema).parquet(*paths))


def summed(keys: tuple[str, ...], count_col: str = "count") -> Callable[[DataFrame], DataFrame]:
    """The merge of a make-up: counts add up per key."""
    return lambda rows: rows.groupBy(*keys).agg(F.sum(count_col).cast("bigint").alias(count_col))


# ------------------------------------------------------------------- moments

MOMENTS = "pos int, n long, mean double, m2 double"


def merge_moments(rows: DataFrame) -> DataFrame:
    """Chan's rule for any number of parts: ``M2 = sum M2_i + sum n_i (mean_i - mean)^2``."""
    live = rows.where(F.col("n") > 0)
    whole = live.groupBy("pos").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    gap = F.col("mean") - F.col("_mean")
    return (live.join(F.broadcast(whole), "pos")        # one row per feature
            .groupBy("pos").agg(F.sum("n").alias("n"), F.first("_mean").alias("mean"),
                                F.sum(F.col("m2") + F.col("n") * gap * gap).alias("m2"))
            .select(F.col("pos").cast("int").alias("pos"), "n", "mean", "m2"))


class StreamMoments:
    """A2 on a stream: per-dimension count, mean and spread of all batches so far."""

    def __init__(self, spark: SparkSession, root: str, dim: int, features: str = "features",
                 every: int = 16):
        self.log = DeltaLog(spark, root, MOMENTS, merge_moments, every)
        self.dim, self.features = dim, features

    def process(self, batch: DataFrame, batch_id: int) -> None:
        from clusterlens.operators.stats import feature_moments
        m = feature_moments(batch, self.features, self.dim)
        self.log.append(m.select(F.col("pos").cast("int").alias("pos"), "n", "mean",
                                 (F.col("std") * F.col("std") * F.col("n")).alias("m2")), batch_id)

    def moments(self) -> DataFrame:
        """``pos, n, mean, std`` as ``feature_moments`` gives them for a batch."""
        return self.log.state().select("pos", "n", "mean", F.sqrt(F.col("m2") / F.col("n")).alias("std"))


# ------------------------------------------------------------------- windows

class WindowScores:
    """R5 on a stream: event-time windows with late records counted.

    The watermark of a batch is the latest event time of the batches before it
    less ``delay``; a record whose window ended by then is late: it is counted
    under its window and enters no score, as on the engine's own watermark, so
    the records of a window and its late records add up to the input. Records
    without an event time belong to no window.
    """

    SCHEMA = "start {t}, finish {t}, n long, scored long, total double, late long, latest {t}"

    def __init__(self, spark: SparkSession, root: str, time_type: str, time_col: str = "ts",
                 duration: str = "1 hour", delay: str = "1 hour", dist_col: str = "dist", every: int = 16):
        self.time_col, self.duration, self.delay, self.dist_col = time_col, duration, delay, dist_col
        self.log = DeltaLog(spark, root, self.SCHEMA.format(t=time_type), self._merge, every)

    @staticmethod
    def _merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy("start", "finish").agg(
            *[F.sum(c).alias(c) for c in ("n", "scored", "total", "late")], F.max("latest").alias("latest"))

    def watermark(self, before: int | None = None):
        return self.log.state(before).agg(
            (F.max("latest") - F.expr(f"INTERVAL {self.delay}")).alias("w")).first()["w"]

    def process(self, batch: DataFrame, batch_id: int) -> None:
        known = self.watermark(batch_id)
        w, d = F.window(self.time_col, self.duration), col_of(self.dist_col)
        rows = batch.where(F.col(self.time_col).isNotNull()).select(
            w.alias("w"), F.col(self.time_col).alias("latest"), d.alias("d"))
        late = F.lit(False) if known is None else F.col("w.end") <= F.lit(known)
        self.log.append(rows.groupBy(F.col("w.start").alias("start"), F.col("w.end").alias("finish")).agg(
            F.count(F.when(~late, 1)).alias("n"), F.count(F.when(~late, F.col("d"))).alias("scored"),
            F.coalesce(F.sum(F.when(~late, F.col("d"))), F.lit(0.0)).alias("total"),
            F.count(F.when(late, 1)).alias("late"), F.max("latest").alias("latest")), batch_id)

    def scores(self) -> DataFrame:
        """``window_start, n, mean_dist, late, closed`` of every window so far."""
        now = self.watermark()
        closed = F.lit(False) if now is None else F.col("finish") <= F.lit(now)
        return self.log.state().select(
            F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n",
            F.when(F.col("scored") > 0, F.col("total") / F.col("scored")).alias("mean_dist"),
            "late", closed.alias("closed"))
