"""Delimited record sources and sinks.

``scan_text`` keeps the raw line (needed when the original record is
reported beside its score, P7); ``scan_csv`` reads typed columns straight
from the files with a declared schema (no inference pass) and sends
malformed lines to a corrupt-record column instead of failing the job.
Both are splittable file scans, so they parallelise over the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``line``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
             corrupt_col: str | None = None) -> DataFrame:
    """S1 typed: headerless delimited records read with ``schema``.

    With ``corrupt_col`` the schema gains that string column and malformed
    lines land there (PERMISSIVE mode) instead of failing the read.
    """
    reader = spark.read.option("header", "false").option("sep", sep)
    if corrupt_col:
        schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
    return reader.schema(schema).csv(path)


def with_record_id(df: DataFrame, out: str = "rid", line_col: str = "line") -> DataFrame:
    """A stable id for records read straight from files (the lines carry
    none): the line's md5. It depends on nothing but the line, neither on
    files nor on splits, so hash splits and replays keep their records. Equal
    lines have equal ids and fall into the same part of a split; a batch whose
    copies are to be split one by one takes ``numbered_records``.
    """
    return df.withColumn(out, F.md5(F.col(line_col)))


COPIES = 4_096              # copies of a line that one task numbers together


def numbered_records(df: DataFrame, out: str = "rid", line_col: str = "line") -> DataFrame:
    """``rid, line`` with an id of its own for every record, equal lines included.

    The id is the line's md5 and the number of the copy, so a split or sample by
    it takes its share of the copies of a line, and it depends on nothing but the
    lines. Copies of a line cannot be told apart, so they are counted, not moved:
    a line travels once with its number of copies and is dealt out again in
    blocks of ``COPIES``, whatever its share of all records. A null line is left
    out.
    """
    counted = df.where(F.col(line_col).isNotNull()).groupBy(line_col).agg(F.count(F.lit(1)).alias("n"))
    blocks = counted.select(
        line_col, "n", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {COPIES}"))).alias("block"))
    dealt = blocks.repartition(line_col, "block")
    first = F.col("block") * COPIES + 1
    copy = F.explode(F.sequence(first, F.least(first + (COPIES - 1), F.col("n")))).alias("copy")
    return dealt.select(line_col, copy).select(
        F.concat_ws(":", F.md5(F.col(line_col)), F.col("copy")).alias(out), line_col)


def record_count(df: DataFrame) -> DataFrame:
    """One row ``n``."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def write_lines(df: DataFrame, path: str, line_col: str = "line") -> None:
    """Write one text line per row (overwrite)."""
    df.select(F.col(line_col).alias("value")).write.mode("overwrite").text(path)
