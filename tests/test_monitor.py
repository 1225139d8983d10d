from pyspark.sql import functions as F

from clusterlens.operators import sample as sm
from clusterlens.plans import fixtures as fx
from clusterlens.plans import train as tr
from clusterlens.plans.monitor import StreamMonitor
from clusterlens.schema import REPORT_JSON_SCHEMA
from clusterlens.session import scratch_path
from clusterlens.streaming.score import file_stream, read_latest_snapshot
from conftest import SF_SMALL


def test_train_then_monitor_stream(spark):
    lines = fx.record_lines(spark, SF_SMALL)
    trained = tr.train(lines, fx.RECORD_LAYOUT, k=5, runs=2, sample=0.2, seed=11, n_top=20,
                       encoding="mixed")
    assert trained.model.centers.k == 5 and trained.n_train > 0
    assert trained.detector.threshold is not None

    src = scratch_path(spark, "t-lines")
    tagged = lines.withColumn("_p", sm.split_index("rid", (1, 1, 1), 5))
    for i in range(3):
        tagged.where(F.col("_p") == i).drop("_p").coalesce(1).write.parquet(f"{src}/{i}")
    root = scratch_path(spark, "t-monitor")
    mon = StreamMonitor(spark, root, trained.parse, trained.detector)
    q = mon.start(file_stream(spark, f"{src}/*", lines.schema, max_files_per_trigger=1), scratch_path(spark, "t-ckpt"),
                  {"availableNow": True})
    q.awaitTermination()

    assert mon.metrics().count() == 3
    streamed = {r.rid for r in mon.anomalies().collect()}
    batch = {r.rid for r in trained.detector.anomalies(trained.parse(lines)).collect()}
    assert streamed == batch
    snap = read_latest_snapshot(spark, f"{root}/report", REPORT_JSON_SCHEMA)
    assert snap.agg(F.sum("count")).first()[0] > 0
    assert mon.running().agg(F.sum("count")).first()[0] == mon.counts().agg(F.sum("parsed")).first()[0]


def test_numeric_training_matches_main_job_shape(spark):
    lines = fx.record_lines(spark, SF_SMALL)
    trained = tr.train(lines, fx.RECORD_LAYOUT, k=3, runs=1, sample=0.3, seed=11, n_top=10)
    assert trained.dictionary is None and trained.model.centers.dim == 4
    scored = tr.score_all(lines, fx.RECORD_LAYOUT, trained)
    rep = tr.report_all(scored).collect()
    assert sum(r["count"] for r in rep) == lines.count()


def test_save_and_load_model(spark):
    from clusterlens.session import scratch_path
    lines = fx.record_lines(spark, SF_SMALL)
    trained = tr.train(lines, fx.RECORD_LAYOUT, k=4, runs=1, sample=0.3, seed=11, n_top=10,
                       encoding="mixed")
    path = scratch_path(spark, "t-model")
    tr.save(spark, trained, path)
    back = tr.load(spark, path)
    assert back.layout == trained.layout and back.model.k == 4
    assert back.detector.threshold == trained.detector.threshold
    assert back.normalizer.means == trained.normalizer.means
    a = {r.rid: (r.cluster, r.dist) for r in trained.detector.score(trained.parse(lines)).collect()}
    b = {r.rid: (r.cluster, r.dist) for r in back.detector.score(back.parse(lines)).collect()}
    assert a == b
