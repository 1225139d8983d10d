import numpy as np
from pyspark.sql import functions as F

from clusterlens.operators.ordering import positions


def test_positions_and_running_sum_match_sorted_brute_force(spark):
    rng = np.random.RandomState(1)
    vals = rng.randint(0, 5, size=3000).astype(float)  # many ties in the first key
    df = spark.createDataFrame([(int(i), float(v)) for i, v in enumerate(vals)],
                               "id long, value double").repartition(6)
    out = positions(df, [F.col("value").desc(), F.col("id").asc()], "pos", "value", "cum")
    got = sorted((r.pos, r.id, r.cum) for r in out.collect())
    order = sorted(range(len(vals)), key=lambda i: (-vals[i], i))
    cum = np.cumsum(vals[order])
    assert [g[0] for g in got] == list(range(len(vals)))
    assert [g[1] for g in got] == order
    np.testing.assert_allclose([g[2] for g in got], cum, rtol=1e-12)


def test_positions_empty(spark):
    df = spark.createDataFrame([], "id long, value double")
    assert positions(df, [F.col("id")], "pos", "value").count() == 0


def test_positions_with_many_shuffle_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"),
                                         F.lit(1.0).alias("v"))
        out = positions(df, [F.col("k").asc()], "pos", "v", "cum").collect()
        assert sorted(r.pos for r in out) == list(range(5000))
        assert all(r.pos == r.k and r.cum == r.k + 1 for r in out)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
