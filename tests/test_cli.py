import json

from pyspark.sql import functions as F

from clusterlens.__main__ import main
from clusterlens.session import scratch_path
from clusterlens.sources import records as rec
from test_connection_records import connection_lines


def test_train_then_monitor_jobs(spark, capsys):
    src, out, model = (scratch_path(spark, n) for n in ("t-cli-in", "t-cli-out", "t-cli-model"))
    lines = spark.createDataFrame(connection_lines(400), "rid string, line string")
    rec.write_lines(lines.repartition(3), src)
    ids = rec.with_record_id(rec.scan_text(spark, src))
    first = sorted(r.rid for r in ids.collect())
    assert len(set(first)) == 400 and first == sorted(r.rid for r in ids.collect())

    main(["train", "--input", src, "--out", out, "--model", model, "--k", "3", "--runs", "1",
          "--sample", "0.5", "--top", "10", "--encoding", "mixed"])
    scores = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert scores["k"] == 3 and scores["n_train"] > 0
    assert spark.read.json(out).agg(F.sum("count")).first()[0] == 400

    state = scratch_path(spark, "t-cli-state")
    main(["monitor", "--model", model, "--input-dir", src, "--state", state, "--once"])
    metrics = spark.read.parquet(f"{state}/monitor/model/metrics")
    assert metrics.agg(F.sum("n")).first()[0] == 400
