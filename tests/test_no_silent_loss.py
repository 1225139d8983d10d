"""Nothing is lost or changed without notice: widths, non-finite numbers,
small splits, ids, entropies, numbers, paths."""

import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clusterlens.operators import evaluate as ev
from clusterlens.operators import kmeans as km
from clusterlens.operators import parse as ps
from clusterlens.operators import sample as sm
from clusterlens.operators import stats as st
from clusterlens.operators.report import number_text, sort_rows
from clusterlens.schema import RecordLayout
from clusterlens.session import path_exists, scratch_path
from clusterlens.sources.records import with_record_id


def points(spark, vectors, label="int"):
    return spark.createDataFrame([(i % 2 if label == "int" else "ab"[i % 2], v)
                                  for i, v in enumerate(vectors)],
                                 f"label {label}, features array<double>")


def test_unequal_widths_stop_the_job(spark):
    mixed = points(spark, [[1.0, 2.0, 3.0], [1.0, 2.0], [2.0, 2.0, 2.0]])
    with pytest.raises(PySparkException, match="another width"):
        st.feature_moments(mixed, dim=2).collect()
    with pytest.raises(PySparkException, match="another width"):
        km.group_means(mixed, dim=3).collect()
    with pytest.raises(ValueError, match="unequal width"):
        st.Normalizer.fit(mixed)
    same = points(spark, [[1.0, 2.0], None, [3.0, 4.0]])
    assert st.Normalizer.fit(same, dim=2).means == (2.0, 3.0)


def test_string_groups_are_numbered_in_order(spark):
    rows = km.group_means(points(spark, [[1.0], [5.0], [3.0]], "string"), dim=1).collect()
    assert sorted((r.cluster, r.label, r.center) for r in rows) == [(0, "a", [2.0]), (1, "b", [5.0])]


@pytest.mark.parametrize("value", ["NaN", "Infinity", "-Infinity", "x", ""])
def test_non_finite_fields_are_quarantined(spark, value):
    layout = RecordLayout(width=3, categorical=(), names=("a", "b", "label"))
    lines = spark.createDataFrame([(f"1,{value},n.",), ("1,2,n.",)], "line string")
    counts = ps.quarantine_counts(ps.parse_numeric(lines, layout)).first()
    assert (counts.parsed, counts.quarantined, counts.total) == (1, 1, 2)


def test_width_of_unlabelled_and_tab_records(spark):
    plain = spark.createDataFrame([("1,2",), ("1,2,3",)], "line string")
    assert [r.ok for r in ps.parse_unlabelled(plain, width=3).collect()] == [False, True]
    tab = plain.select(F.concat(F.lit("7\t"), "line").alias("line"))
    assert [r.ok for r in ps.parse_tab_labelled(tab, width=2).collect()] == [True, False]


def test_small_parts_are_not_rounded_away(spark):
    ids = spark.range(300_000)
    small, rest = sm.hash_split(ids, (0.00004, 0.99996), 11)
    n = small.count()
    assert 2 <= n <= 30 and n + rest.count() == 300_000


def test_bootstrap_ignores_the_partition_layout(spark):
    ids = spark.range(20_000)
    one = sm.bootstrap_sample(ids.coalesce(1), 1.5, 3).groupBy("id").count()
    many = sm.bootstrap_sample(ids.repartition(7), 1.5, 3).groupBy("id").count()
    a, b = ({r["id"]: r["count"] for r in d.collect()} for d in (one, many))
    assert a == b and abs(sum(a.values()) / 20_000 - 1.5) < 0.05
    assert abs(sum(v == 1 for v in a.values()) / 20_000 - 1.5 * math.exp(-1.5)) < 0.02


def test_record_ids_do_not_depend_on_splits(spark):
    path = scratch_path(spark, "ids")
    spark.range(5_000).select(F.concat(F.lit("r"), "id")).write.text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = []
    try:
        for size in ("4k", "64m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            lines = spark.read.text(path).withColumnRenamed("value", "line")
            got.append({r.line: r.rid for r in with_record_id(lines).collect()})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got[0] == got[1] and len(set(got[0].values())) == 5_000


def test_entropy_is_zero_for_pure_clusters_and_never_below(spark):
    rng = random.Random(0)
    pure = [(i, "x", rng.randint(1, 10**6)) for i in range(500)]
    rows = ev.cluster_entropy(spark.createDataFrame(
        pure + [(1000, "a", 1), (1000, "b", 10**9)], "cluster int, label string, count long")).collect()
    assert all(r.entropy == 0.0 for r in rows if r.cluster < 1000)
    assert all(r.entropy > 0.0 for r in rows if r.cluster == 1000)


def test_numbers_keep_their_digits(spark):
    df = spark.createDataFrame([(1e15,), (123456789012345680000.0,), (2.5,), (-3.0,)], "v double")
    assert [r[0] for r in df.select(number_text("v")).collect()] == [
        "1000000000000000", "123456789012345680000", "2.5", "-3"]


def test_random_order_is_the_same_on_any_layout(spark):
    rows = spark.createDataFrame([(c, 1.0) for c in "abcdefgh"], "label string, value double")
    a, b = ([r.label for r in sort_rows(d, "random", seed=5).orderBy("pos").collect()]
            for d in (rows.coalesce(1), rows.repartition(4)))
    assert a == b and a != sorted(a)


def test_paths_with_and_without_a_scheme_agree(spark):
    path = scratch_path(spark, "paths")
    bare = path.removeprefix("file://").removeprefix("file:")
    for p in (bare, f"file://{bare}"):
        assert not path_exists(spark, p)
    spark.range(1).write.parquet(path)
    for p in (bare, f"file://{bare}", bare + "/_SUCCESS"):
        assert path_exists(spark, p)
    assert not path_exists(spark, bare + "/missing")
