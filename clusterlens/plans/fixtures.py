"""Inputs derived by Spark from the given tables (see FIXTURES.md).

* connection-like record lines from ``lineitem JOIN orders``: one numeric
  field, three categorical fields, three numerics, a label ending in ``.``
  (the same shape as the reference's records, 8 fields wide);
* labelled points from ``embeddings`` (64-dim) and from ``events``;
* given centres: one per embedding label (the label's mean vector), so
  model-dependent results can be checked in SQL without a fitted
  (partition-layout-dependent) model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.functions.vectors import as_double_array
from clusterlens.schema import RecordLayout

RECORD_LAYOUT = RecordLayout(
    width=8, categorical=(1, 2, 3),
    names=("l_quantity", "l_returnflag", "l_linestatus", "o_orderpriority",
           "l_extendedprice", "l_discount", "l_tax", "label"))

EMBEDDING_DIM = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rid, line``: one comma-separated record per lineitem row.

    ``rid`` = orderkey:linenumber:partkey:suppkey (unique in the given data;
    it is carried beside the line, as the reference's lines have no id).
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_returnflag", "l_linestatus", "l_extendedprice", "l_discount", "l_tax")
    od = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    s = lambda c: F.col(c).cast("string")
    line = F.concat_ws(",", s("l_quantity"), "l_returnflag", "l_linestatus",
                       "o_orderpriority", s("l_extendedprice"), s("l_discount"),
                       s("l_tax"), F.concat(F.col("o_orderstatus"), F.lit(".")))
    rid = F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return j.select(rid.alias("rid"), line.alias("line"))


HOT_LINE = "1.0,N,O,3-MEDIUM,1000.0,0.0,0.0,O."


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line``: the record lines, 57 in a hundred (by the hash of their id)
    replaced by one and the same line."""
    place = (F.conv(F.substring(F.md5(F.concat(F.lit("copy:"), "rid")), 1, 8), 16, 10)
             .cast("bigint") % 100)
    return record_lines(spark, sf_dir).select(
        F.when(place < 57, F.lit(HOT_LINE)).otherwise(F.col("line")).alias("line"))


def spoiled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rid, line, kind``: the record lines, about four in a hundred spoiled
    by the hash of their id: kind 0 lacks a field, 1 has text, 2 NaN and 3 an
    infinity for its first number; other kinds are whole."""
    lines = record_lines(spark, sf_dir).withColumn("kind", (
        F.conv(F.substring(F.md5(F.concat(F.lit("spoil:"), "rid")), 1, 8), 16, 10)
        .cast("bigint") % 100).cast("int"))
    rest = F.regexp_replace("line", "^[^,]*", "")
    line = (F.when(F.col("kind") == 0, F.regexp_replace("line", "^[^,]*,", ""))
            .when(F.col("kind") == 1, F.concat(F.lit("many"), rest))
            .when(F.col("kind") == 2, F.concat(F.lit("NaN"), rest))
            .when(F.col("kind") == 3, F.concat(F.lit("-Infinity"), rest))
            .otherwise(F.col("line")))
    return lines.withColumn("line", line)


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, label, features ARRAY<DOUBLE>`` from embeddings."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), "label",
        as_double_array("embedding").alias("features"))


def given_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cluster, center``: one centre per embedding label, the label's mean
    vector over the whole table (cluster id = label)."""
    from clusterlens.operators.kmeans import group_means
    return group_means(embedding_points(spark, sf_dir), "label", dim=EMBEDDING_DIM)


def order_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rid, grid, features``: order lines as [quantity, discount and tax in per
    cent, price in thousands]; ``grid`` numbers their quantity and discount."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("rid"),
        (F.round("l_quantity").cast("int") * 100
         + F.round(F.col("l_discount") * 100).cast("int")).alias("grid"),
        F.array(F.col("l_quantity").cast("double"), F.col("l_discount") * 100.0,
                F.col("l_tax") * 100.0, F.col("l_extendedprice") / 1000.0).alias("features"))


def grid_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cluster, center``: the mean order line of every quantity and discount
    (some hundred centres whatever the size of the table)."""
    from clusterlens.operators.kmeans import group_means
    return group_means(order_points(spark, sf_dir), "grid", dim=4)


def embedding_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, line`` with ``label<TAB>f0,f1,...`` (tab-labelled stream record)
    and ``id, plain`` with ``f0,f1,...`` (unlabelled record)."""
    e = embedding_points(spark, sf_dir)
    nums = F.array_join(F.transform("features", lambda x: x.cast("string")), ",")
    return e.select("id",
                    F.concat(F.col("label").cast("string"), F.lit("\t"), nums)
                    .alias("line"),
                    nums.alias("plain"))


def event_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, label, ts, features=[value, props.k]`` from events."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("double")
    return ev.select(F.col("event_id").alias("id"),
                     F.col("event_type").alias("label"), "ts",
                     F.array(F.col("value").cast("double"), k).alias("features"))
