"""Session defaults and the shared folder used for checkpoints and state.

Every operator in the package is a plain ``DataFrame -> DataFrame`` function;
the only session-level things they rely on are gathered here.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoints written for stable numbering (ordering.positions) are
    # removed once their DataFrames are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "clusterlens",
              shuffle_partitions: int | None = None,
              conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster ``master`` is left to ``spark-submit``; tests pass
    ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf or {})
    for key, value in merged.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only a local session (tests, bench)
    without the setting gets a fresh folder of its own; a cluster session
    without it is an error, because a machine-local folder would not survive
    the loss of an executor.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; clusterlens needs a shared "
                "folder for checkpoints and streaming state")
        root = tempfile.mkdtemp(prefix="clusterlens-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df, name: str):
    """``df`` written to the shared folder and read back: a small result that
    several later steps use, computed once and kept if an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists, on whatever file system it names.

    Resolved by the session's reader, which lists the path and fails if it is
    absent; so a path without a scheme means the session's default file system,
    as it does everywhere else, not the driver's disk.
    """
    try:
        spark.read.format("text").load(path)
        return True
    except AnalysisException:
        return False
