
from clusterlens.schema import CONNECTION_LAYOUT, connection_schema, layout_schema
from clusterlens.session import checkpoint_root, scratch_path
from clusterlens.sources import records as rec
from clusterlens.operators import parse as ps


def test_connection_layout():
    assert CONNECTION_LAYOUT.width == 42 and len(CONNECTION_LAYOUT.numeric) == 38
    s = connection_schema()
    assert s["protocol_type"].dataType.simpleString() == "string"
    assert s["duration"].dataType.simpleString() == "double"
    assert s["label"].dataType.simpleString() == "string"


def test_typed_scan_keeps_corrupt_lines(spark):
    path = scratch_path(spark, "t-csv")
    lines = spark.createDataFrame([("1,tcp,http,SF,5,smurf.",), ("x,tcp,http,SF,5,bad.",),
                                   ("2,udp,dns,S0,7,normal.",)], "line string")
    rec.write_lines(lines, path)
    from clusterlens.schema import RecordLayout
    lay = RecordLayout(width=6)
    df = rec.scan_csv(spark, path, layout_schema(lay), corrupt_col="_corrupt").cache()
    rows = sorted(df.collect(), key=lambda r: str(r.f5))
    assert df.count() == 3
    bad = [r for r in rows if r._corrupt is not None]
    assert len(bad) == 1 and bad[0]._corrupt.startswith("x,")
    assert rec.record_count(rec.scan_text(spark, path)).first().n == 3
    parsed = ps.parse_numeric(rec.scan_text(spark, path), lay)
    assert ps.quarantine_counts(parsed).first().quarantined == 1


def test_checkpoint_root_prefers_session_setting(spark):
    root = checkpoint_root(spark)
    assert spark.conf.get("spark.checkpoint.dir") == root
    assert scratch_path(spark, "x").startswith(root + "/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
