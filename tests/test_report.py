import json

import pytest
from pyspark.sql import functions as F

from clusterlens.operators import report as rp
from clusterlens.session import scratch_path
from clusterlens.sources.report_json import read_report_json, write_report_json


def chart(spark, rows):
    return spark.createDataFrame(rows, "label string, value double")


def test_group_small_boundary(spark):
    rows = rp.sort_rows(chart(spark, [("big", 98.0), ("s1", 1.0), ("s2", 1.0)]), "value-desc")
    out = rp.group_small(rows, 1.0, "percentage", label="Other").orderBy("pos").collect()
    assert [(r.label, r.value, r.is_grouped, r.members) for r in out] == \
        [("big", 98.0, False, 0), ("Other", 2.0, True, 2)]
    members = rp.group_members(rows, 1.0).collect()
    assert sorted(r.label for r in members) == ["s1", "s2"]
    by_value = rp.group_small(rows, 1.0, "value").collect()
    assert sum(r.value for r in by_value) == 100.0


def test_group_small_none_small(spark):
    rows = rp.sort_rows(chart(spark, [("a", 50.0), ("b", 50.0)]), "label-asc")
    out = rp.group_small(rows, 1.0).collect()
    assert len(out) == 2 and not any(r.is_grouped for r in out)


def test_validate(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 0.0), ("c", -1.0), ("d", float("nan")), ("e", None)],
                               "label string, value double")
    assert [r.label for r in rp.validate(df).collect()] == ["a"]


def test_caption_unknown_placeholder_stays(spark):
    df = chart(spark, [("Smurf", 98.0), ("x", 1.5)])
    out = df.select(rp.caption("{label}: {value} {nope}",
                               {"label": F.col("label"), "value": rp.number_text("value")})
                    .alias("c")).collect()
    assert [r.c for r in out] == ["Smurf: 98 {nope}", "x: 1.5 {nope}"]


def test_truncate(spark):
    df = chart(spark, [("abcdefghijkl", 1.0), ("short", 1.0)])
    assert [r.t for r in df.select(rp.truncate_label("label", 10).alias("t")).collect()] == \
        ["abcdefghij...", "short"]


def test_shares_sum_to_100_and_running_share(spark):
    df = rp.sort_rows(chart(spark, [("a", 1.0), ("b", 2.0), ("c", 5.0)]), "value-asc")
    sh = rp.with_share(df, decimals=1)
    assert sum(r.share_exact for r in sh.collect()) == pytest.approx(100.0)
    rs = {r.label: (r.end_share, r.mid_share) for r in rp.running_share(df).collect()}
    assert rs["a"] == pytest.approx((12.5, 6.25))
    assert rs["c"] == pytest.approx((100.0, 100.0 - 31.25))
    hidden = {r.label: r.hidden for r in rp.hide_below(sh, 30.0).collect()}  # 12.5, 25, 62.5
    assert hidden == {"a": True, "b": True, "c": False}


def test_sort_orders(spark):
    df = chart(spark, [("b", 2.0), ("A", 3.0), ("c", 1.0)])
    def order(o):
        return [r.label for r in rp.sort_rows(df, o).orderBy("pos").collect()]
    assert order("value-asc") == ["c", "b", "A"]
    assert order("value-desc") == ["A", "b", "c"]
    assert order("label-asc") == ["A", "b", "c"]
    assert order("label-desc") == ["c", "b", "A"]
    assert sorted(order("random")) == ["A", "b", "c"]


def test_upsert_modes(spark):
    old = spark.createDataFrame([(0, "a", 5), (1, "b", 2)], "cluster int, label string, count long")
    new = spark.createDataFrame([(0, "a", 7), (2, "c", 1)], "cluster int, label string, count long")
    rep = {(r.cluster, r.label): r["count"] for r in rp.upsert(old, new).collect()}
    assert rep == {(0, "a"): 7, (1, "b"): 2, (2, "c"): 1}
    s = {(r.cluster, r.label): r["count"] for r in rp.upsert(old, new, mode="sum").collect()}
    assert s == {(0, "a"): 12, (1, "b"): 2, (2, "c"): 1}


def test_report_json_round_trip(spark):
    path = scratch_path(spark, "t-report")
    rep = spark.createDataFrame([(0, "smurf.", 280790), (0, "neptune.", 107201)],
                                "cluster int, label string, count long")
    write_report_json(rep, path)
    back = {(r.cluster, r.label): r.value for r in read_report_json(spark, path).collect()}
    assert back == {(0, "smurf"): 280790, (0, "neptune"): 107201}


def test_report_json_reads_dashboard_array(spark, tmp_path):
    p = tmp_path / "report.json"
    p.write_text(json.dumps([{"cluster": 0, "label": "Smurf", "count": 280790},
                             {"cluster": 0, "label": "Back", "count": 2203}]))
    back = read_report_json(spark, str(p), multi_line=True).orderBy("value").collect()
    assert [(r.label, r.value) for r in back] == [("Back", 2203), ("Smurf", 280790)]


def test_label_formatter_hook_wins_over_truncation(spark):
    df = chart(spark, [("abcdefghijkl", 3.0)])
    plain = rp.label_text(df, truncate=4).first().label_text
    hooked = rp.label_text(df, formatter=lambda lab, val: F.concat(F.upper(lab), F.lit("="),
                                                                   val.cast("int").cast("string"))).first()
    assert plain == "abcd..." and hooked.label_text == "ABCDEFGHIJKL=3"


def test_caption_parser_hook(spark):
    df = chart(spark, [("a", 2.0)])

    def parser(fields):
        fields["label"] = F.upper(fields["label"])
        fields["extra"] = F.lit("!")
        return fields

    out = df.select(rp.caption("{label}{extra} {value}", {"label": F.col("label"),
                                                          "value": rp.number_text("value")},
                               parser=parser).alias("c")).first().c
    assert out == "A! 2"
