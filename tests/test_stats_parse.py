import math

import pytest
from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F

from clusterlens.operators import encode as enc
from clusterlens.operators import parse as ps
from clusterlens.operators import sample as sm
from clusterlens.operators import stats as stt
from clusterlens.schema import RecordLayout


def vecs(spark, rows, parts=1):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(rows)],
                                 "id long, features array<double>").repartition(parts)


def test_zero_std_column(spark):
    df = vecs(spark, [(1, 5), (2, 5), (3, 5)])
    nz = stt.Normalizer.fit(df)
    out = sorted(tuple(r.features) for r in nz.apply(df).collect())
    assert [o[1] for o in out] == [0.0, 0.0, 0.0]
    unseen = nz.apply(vecs(spark, [(2, 7)])).first().features
    assert unseen[1] == 2.0 and unseen[0] == 0.0


@pytest.mark.parametrize("parts", [1, 2, 3])
def test_population_std_any_partitioning(spark, parts):
    m = stt.feature_moments(vecs(spark, [(1,), (2,), (3,), (4,)], parts)).first()
    assert m["mean"] == pytest.approx(2.5)
    assert m["std"] == pytest.approx(math.sqrt(1.25))
    assert m["n"] == 4


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.floats(-1e3, 1e3), st.floats(-1e3, 1e3)), min_size=2, max_size=30))
def test_zscore_has_mean_zero_and_unit_or_zero_std(spark, rows):
    df = vecs(spark, rows, 2)
    z = stt.zscore(df)
    m = stt.feature_moments(z, dim=2).orderBy("pos").collect()
    for r in m:
        assert abs(r["mean"]) < 1e-9
        assert r["std"] == pytest.approx(1.0, abs=1e-9) or r["std"] < 1e-9


def test_label_counts_descending(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("c",)], "label string")
    assert [(r.label, r["count"]) for r in stt.label_counts(df).collect()] == \
        [("b", 2), ("c", 2), ("a", 1)]


LAYOUT = RecordLayout(width=6, categorical=(1, 2, 3))


def lines(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "rid int, line string")


def test_one_hot_order(spark):
    fit = lines(spark, ["0,x,m,u,0,a.", "0,y,m,v,0,b."])
    d = enc.fit_categories(fit, LAYOUT)
    out = enc.parse_mixed(lines(spark, ["1,y,m,u,9,lab."]), LAYOUT, d).first()
    assert list(out.features) == [1.0, 0.0, 1.0, 1.0, 1.0, 0.0, 9.0]
    assert out.label == "lab." and out.unseen is False and out.ok is True


def test_unseen_category_gives_zero_block(spark):
    d = enc.fit_categories(lines(spark, ["0,a,m,u,0,l.", "0,b,m,u,0,l."]), LAYOUT)
    out = enc.parse_mixed(lines(spark, ["2,c,m,u,3,l."]), LAYOUT, d).first()
    assert list(out.features) == [2.0, 0.0, 0.0, 1.0, 1.0, 3.0]
    assert out.unseen is True


def test_dictionary_join_path_equals_map_path(spark, monkeypatch):
    fit = lines(spark, ["0,x,m,u,0,a.", "0,y,n,v,0,b.", "0,z,m,w,0,c."])
    d = enc.fit_categories(fit, LAYOUT)
    data = lines(spark, ["1,y,m,u,9,l.", "2,q,n,w,8,l.", "3,z,n,v,7,l."])
    a = {r.rid: (list(r.features), r.unseen) for r in enc.parse_mixed(data, LAYOUT, d, keep=("rid",)).collect()}
    monkeypatch.setattr(enc, "MAP_LITERAL_LIMIT", 0)
    b = {r.rid: (list(r.features), r.unseen) for r in enc.parse_mixed(data, LAYOUT, d, keep=("rid",)).collect()}
    assert a == b


def test_malformed_records_are_quarantined(spark):
    df = lines(spark, ["1,x,m,u,2,ok.", "1,x,m", "abc,x,m,u,2,bad.", "4,x,m,u,5,ok."])
    p = ps.parse_numeric(df, LAYOUT, keep=("rid",))
    counts = ps.quarantine_counts(p).first()
    assert (counts.parsed, counts.quarantined, counts.total) == (2, 2, 4)
    assert sorted(r.rid for r in ps.quarantine(p).collect()) == [1, 2]
    assert all(r.features is None for r in ps.quarantine(p).collect())
    good = {r.rid: list(r.features) for r in ps.valid(p).collect()}
    assert good == {0: [1.0, 2.0], 3: [4.0, 5.0]}


def test_tab_labelled_and_unlabelled(spark):
    df = spark.createDataFrame([("3\t1.5,2,-1e3", "1,2"), ("x\t1", "1,y")], "line string, plain string")
    t = ps.parse_tab_labelled(df).collect()
    assert t[0].label == 3.0 and list(t[0].features) == [1.5, 2.0, -1000.0] and t[0].ok
    assert t[1].ok is False and t[1].features is None
    u = ps.parse_unlabelled(df, line_col="plain").collect()
    assert list(u[0].features) == [1.0, 2.0] and u[1].ok is False


def test_label_cleaning(spark):
    df = spark.createDataFrame([("smurf.",), ("neptune",), ("a.b.",)], "label string")
    out = df.select(ps.clean_label("label").alias("c"), ps.display_label("label").alias("d")).collect()
    assert [(r.c, r.d) for r in out] == [("smurf", "Smurf"), ("neptune", "Neptune"), ("a.b", "A.b")]


def test_hash_split_is_stable_and_partition_independent(spark):
    ids = spark.range(0, 2000)
    a = {r.id: r.p for r in ids.select("id", sm.split_index("id", (0.3, 0.7), 5).alias("p")).collect()}
    b = {r.id: r.p for r in ids.repartition(7).select(
        "id", sm.split_index("id", (0.3, 0.7), 5).alias("p")).collect()}
    assert a == b
    share = sum(1 for v in a.values() if v == 0) / len(a)
    assert 0.25 < share < 0.35
    parts = sm.hash_split(ids, (1, 1, 2), 3)
    assert sum(p.count() for p in parts) == 2000


def test_bootstrap_sample_is_seeded(spark):
    ids = spark.range(0, 1000)
    a = sm.bootstrap_sample(ids, 0.5, 3).count()
    assert a == sm.bootstrap_sample(ids, 0.5, 3).count()
    assert 350 < a < 650


def _join_lines(df, capsys):
    df.explain()
    plan = capsys.readouterr().out
    return [l for l in plan.splitlines() if "HashJoin" in l or "SortMergeJoin" in l]


def test_no_parse_expression_is_pushed_into_the_join(spark, capsys):
    """Filters inferred on parsed values must not be inlined below the parse
    (that re-runs split once per reference)."""
    from clusterlens.functions.nearest import CenterSet
    from clusterlens.operators.anomaly import AnomalyDetector
    from clusterlens.plans import fixtures as fx
    from clusterlens.plans import train as tr
    lines = fx.record_lines(spark, "/root/testdata/sf0.001")
    parsed = ps.parse_numeric(lines, fx.RECORD_LAYOUT, keep=("rid",))
    for line in _join_lines(stt.feature_moments(parsed, dim=4), capsys):
        assert "split(" not in line
    nz = stt.Normalizer(means=(0.0,) * 4, stds=(1.0,) * 4, n=1)
    det = AnomalyDetector(nz, CenterSet.from_arrays([0, 1], [[0.0] * 4, [1.0] * 4]), 1.0)
    scored = tr.report_all(det.score(parsed))
    for line in _join_lines(scored, capsys):
        assert "split(" not in line


def test_empty_field_is_a_category_and_missing_fields_quarantine(spark):
    fit = lines(spark, ["1,,m,u,2,a.", "3,,m,v,4,b."])
    d = enc.fit_categories(fit, LAYOUT)
    out = enc.parse_mixed(fit, LAYOUT, d).orderBy("label").collect()
    # "" is a value of the field (one slot), as splitting the line gives it
    assert [list(r.features) for r in out] == [[1.0, 1.0, 1.0, 1.0, 0.0, 2.0],
                                               [3.0, 1.0, 1.0, 0.0, 1.0, 4.0]]
    short = lines(spark, ["1", "2"])  # no categorical field at all: empty dictionaries
    p = enc.parse_mixed(short, LAYOUT, enc.fit_categories(short, LAYOUT))
    assert [r.ok for r in p.collect()] == [False, False]


def test_wide_one_hot_uses_sequence_form(spark):
    df = spark.createDataFrame([(3,), (None,)], "i int")
    out = df.select(enc.one_hot(F.col("i"), 100).alias("v")).collect()
    assert out[0].v[3] == 1.0 and sum(out[0].v) == 1.0 and sum(out[1].v) == 0.0 and len(out[1].v) == 100
