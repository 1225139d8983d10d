"""Queries over record lines read and parse them once per pass (no filter pushed
into the parse, one join, points in blocks)."""

import numpy as np
from pyspark.sql import functions as F

from clusterlens.operators import anomaly as an
from clusterlens.operators import encode as enc
from clusterlens.operators import kmeans_runs as kr
from clusterlens.plans import catalog
from clusterlens.plans import model_search as ms
from clusterlens.schema import RecordLayout
from clusterlens.session import scratch_path

LAYOUT = RecordLayout(width=4, categorical=(1,))


def splits(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("split(")


def record_frame(spark, n=60):
    rows = [(i, f"{i % 7}.5,{'abc'[i % 3]},{(i * i) % 11},L.") for i in range(n)]
    rows += [(n, "x,a,1,L."), (n + 1, "1,a,L."), (n + 2, "500.0,b,900.0,far.")]
    return spark.createDataFrame(rows, "rid int, line string")


def test_parse_mixed_parses_once_and_drops_malformed(spark, tmp_path):
    rows = [(1, 10, 100, 1, 5.0, "A", "F", 10.0, 0.1, 0.2), (2, 11, 101, 1, float("nan"), "N", "O", 11.0, 0.0, 0.1)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity "
                                "double, l_returnflag string, l_linestatus string, l_extendedprice double, "
                                "l_discount double, l_tax double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "1-URGENT", "O"), (2, "5-LOW", "F")],
                          "o_orderkey long, o_orderpriority string, o_orderstatus string").write.parquet(
        f"{tmp_path}/orders.parquet")
    out = catalog.q_parse_mixed(spark, str(tmp_path))
    assert splits(out) == 1
    assert {r.rid for r in out.collect()} == {"1:1:10:100"}


def test_listed_anomalies_parse_once(spark):
    lines = record_frame(spark)
    out = ms.list_anomalies(lines, LAYOUT, k=2, runs=1, n=2, id_col="rid")
    assert splits(out) == 1
    assert [(r.line, r.label) for r in out.collect()] == [("500.0,b,900.0,far.", "far.")]


def test_dictionary_splits_a_line_once(spark):
    layout = RecordLayout(width=4, categorical=(1, 2))
    d = enc.fit_categories(record_frame(spark), layout)
    assert splits(d) == 1
    assert d.where("field = 1").count() == 3


def test_threshold_of_weighted_distances(spark):
    rows = [(5.0, 1), (4.0, 3), (3.0, 2), (1.0, 9), (None, 4)]
    df = spark.createDataFrame(rows, "dist double, w long")
    each = df.select("dist", F.explode(F.expr("sequence(1, w)")))
    for n in (1, 2, 4, 5, 6, 7, 15, 40):
        got = an.distance_threshold(df, n, weight_col="w").first()[0]
        assert got == an.distance_threshold(each, n).first()[0]


def test_blocks_hold_the_points(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3)).round(1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, features array<double>")
    points = kr.weighted_points(df, id_col="id").persist()
    blocks = kr.packed(points)
    shape = kr.shape_of(blocks)
    assert blocks.count() < shape.points == len(np.unique(x, axis=0)) and shape.n == 300
    centers = x[:4]
    s = kr.scan(blocks, shape, [centers])[0]
    d = np.sqrt(((x[:, None] - centers) ** 2).sum(axis=2))
    assert s.rows.sum() == 300 and abs(s.distance - d.min(axis=1).sum()) < 1e-9
    assert np.allclose(s.sums, [x[d.argmin(axis=1) == j].sum(axis=0) for j in range(4)])
    got = kr.distances(blocks, centers).agg(F.sum("w"), F.sum(F.col("w") * F.col("dist"))).first()
    assert got[0] == 300 and abs(got[1] - d.min(axis=1).sum()) < 1e-9
    points.unpersist()


def test_parts_are_written_in_one_pass_and_an_empty_part_is_a_batch(spark):
    seen = []
    rows = spark.range(9).select("id", F.when(F.col("id") < 8, F.col("id") % 2 * 2).alias("p"))

    def process(batch, i):
        seen.append((i, sorted(r.id for r in batch.collect())))
    catalog._in_batches(spark, rows.select("id", "p"), F.col("p"), catalog._each(process), batches=3)
    assert seen == [(0, [0, 2, 4, 6]), (1, []), (2, [1, 3, 5, 7])]
    src = scratch_path(spark, "t-parts")
    catalog._folders(spark, rows, F.col("p"), src, 3)
    back = spark.read.schema(rows.schema).parquet(*[f"{src}/_part={i}" for i in range(3)])
    assert back.count() == 8
