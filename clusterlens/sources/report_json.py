"""JSON report sink and source.

The dashboard reads an array of ``{"cluster", "label", "count"}`` objects.
Spark writes JSON lines (one object per line, splittable); the reader takes
both JSON lines and a single JSON array (``multi_line=True``) and maps
``count`` to the chart's ``value``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.operators.parse import clean_label
from clusterlens.schema import REPORT_JSON_SCHEMA


def write_report_json(report: DataFrame, path: str, strip_dot: bool = True,
                      cluster_col: str = "cluster", label_col: str = "label",
                      count_col: str = "count") -> None:
    """Write ``cluster, label, count`` (label without a trailing ``.``)."""
    label = F.col(label_col).cast("string")
    out = report.select(F.col(cluster_col).cast("int").alias("cluster"),
                        (clean_label(label) if strip_dot else label).alias("label"),
                        F.col(count_col).cast("long").alias("count"))
    out.write.mode("overwrite").json(path)


def read_report_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """``cluster, label, value`` from a written report or a JSON array file."""
    df = (spark.read.schema(REPORT_JSON_SCHEMA)
          .option("multiLine", str(bool(multi_line)).lower()).json(path))
    return df.withColumnRenamed("count", "value")
