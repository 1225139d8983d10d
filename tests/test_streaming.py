import numpy as np
import pytest
from pyspark.sql import functions as F

from clusterlens.functions.nearest import CenterSet, assign
from clusterlens.operators import sample as sm
from clusterlens.operators import stats as stt
from clusterlens.plans import fixtures as fx
from clusterlens.schema import REPORT_JSON_SCHEMA
from clusterlens.session import scratch_path
from clusterlens.streaming import score as ss
from clusterlens.streaming.kmeans_stream import StreamingKMeans, update_model
from conftest import SF_SMALL


def test_update_hand_cases():
    c0, w0 = [[0.0], [10.0]], [1.0, 1.0]
    counts, sums = [3, 0], [[5.0], [0.0]]
    c, w = update_model(c0, w0, counts, sums, 0.5, "batches")
    assert c[0, 0] == pytest.approx(5 / 3.5) and c[1, 0] == 10.0
    assert list(w) == pytest.approx([3.5, 0.5])
    c, w = update_model(c0, w0, counts, sums, 0.5, "points")
    assert c[0, 0] == pytest.approx(1.6) and list(w) == pytest.approx([3.125, 0.125])
    c, w = update_model(c0, w0, counts, sums, 0.0, "batches")
    assert list(w) == pytest.approx([1.5, 1.5])
    assert c[0, 0] == pytest.approx(5 / 3) and c[1, 0] == pytest.approx(5 / 3)


@pytest.mark.parametrize("decay,unit", [(1.0, "batches"), (0.5, "batches"), (0.9, "points")])
def test_update_matches_mllib(spark, decay, unit):
    from pyspark.mllib.clustering import StreamingKMeansModel
    rng = np.random.RandomState(4)
    centers = rng.randn(4, 3)
    weights = rng.rand(4) * 10
    data = rng.randn(50, 3) * 2
    d2 = ((data[:, None, :] - centers[None]) ** 2).sum(-1)
    lab = d2.argmin(1)
    counts = np.bincount(lab, minlength=4)
    sums = np.stack([data[lab == j].sum(0) for j in range(4)])
    c, w = update_model(centers, weights, counts, sums, decay, unit)
    m = StreamingKMeansModel([list(x) for x in centers], list(weights))
    m.update(spark.sparkContext.parallelize([list(x) for x in data]), decay, unit)
    np.testing.assert_allclose(c, np.array([list(x) for x in m.centers]), rtol=1e-10)
    np.testing.assert_allclose(w, np.array(m.clusterWeights), rtol=1e-10)


def write_parts(spark, df, n=4, seed=7):
    src = scratch_path(spark, "t-src")
    tagged = df.withColumn("_p", sm.split_index("id", [1] * n, seed))
    for i in range(n):
        tagged.where(F.col("_p") == i).drop("_p").coalesce(1).write.parquet(f"{src}/{i}")
    return src


def test_streaming_kmeans_equals_mllib_batch_by_batch(spark):
    from pyspark.mllib.clustering import StreamingKMeansModel
    pts = fx.embedding_points(spark, SF_SMALL)
    src = write_parts(spark, pts)
    init = CenterSet.from_df(fx.given_centers(spark, SF_SMALL))
    state = scratch_path(spark, "t-state")
    skm = StreamingKMeans(spark, state, init, initial_weight=100.0, decay=0.8)
    seen = []

    def run(df, bid):
        seen.append((bid, [list(r.features) for r in df.select("features").collect()]))
        skm.process(df, bid)

    stream = ss.file_stream(spark, f"{src}/*", pts.schema, max_files_per_trigger=1)
    q = (stream.writeStream.foreachBatch(run).trigger(availableNow=True)
         .option("checkpointLocation", scratch_path(spark, "t-ckpt")).start())
    q.awaitTermination()
    assert len(seen) == 4 and sum(len(r) for _, r in seen) == 500

    m = StreamingKMeansModel([list(x) for x in init.matrix], [100.0] * init.k)
    for _, rows in sorted(seen):
        m.update(spark.sparkContext.parallelize(rows), 0.8, "batches")
    got = sorted((r.cluster, list(r.center), r.weight) for r in skm.centers().collect())
    np.testing.assert_allclose(np.array([g[1] for g in got]), np.array([list(x) for x in m.centers]),
                               rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose([g[2] for g in got], m.clusterWeights, rtol=1e-9)

    # R2: one metrics row per batch
    assert sorted(r.batch_id for r in skm.metrics().collect()) == [b for b, _ in sorted(seen)]

    # a replayed batch id changes nothing; a restarted object resumes the state
    before = sorted((r.cluster, tuple(r.center)) for r in skm.centers().collect())
    first_bid = sorted(seen)[0][0]
    skm.process(pts, first_bid)
    again = StreamingKMeans(spark, state, init, initial_weight=100.0, decay=0.8)
    after = sorted((r.cluster, tuple(r.center)) for r in again.centers().collect())
    assert before == after


def test_stream_predict_equals_batch(spark):
    pts = fx.embedding_points(spark, SF_SMALL)
    centers = CenterSet.from_df(fx.given_centers(spark, SF_SMALL))
    src = write_parts(spark, pts)
    out = scratch_path(spark, "t-pred")
    stream = ss.file_stream(spark, f"{src}/*", pts.schema, max_files_per_trigger=1)
    q = (ss.predict(stream, centers).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "t-ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    streamed = {r.id: (r.cluster, r.dist) for r in spark.read.parquet(out).collect()}
    batch = {r.id: (r.cluster, r.dist) for r in assign(pts, centers).collect()}
    assert streamed == batch


def test_stream_anomalies_and_windows_equal_batch(spark):
    ev = fx.event_points(spark, SF_SMALL)
    nz = stt.Normalizer.fit(ev)
    z = nz.apply(ev)
    cs = CenterSet.from_arrays(range(3), [[-1.0, 0.0], [0.0, 0.0], [1.0, 1.0]])
    from clusterlens.operators.anomaly import AnomalyDetector
    det = AnomalyDetector.build(ev, cs, nz, n=20)
    # files arrive in event-time order (one week each), as a real stream would
    src = scratch_path(spark, "t-src")
    week = F.floor((F.dayofmonth("ts") - 1) / 7)
    for i in range(5):
        ev.where(week == i).coalesce(1).write.parquet(f"{src}/{i}")
    stream = ss.file_stream(spark, f"{src}/*", ev.schema, max_files_per_trigger=1)

    out_a = scratch_path(spark, "t-anom")
    qa = (ss.anomalies(stream, det).writeStream.format("parquet").option("path", out_a)
          .option("checkpointLocation", scratch_path(spark, "t-ckpt")).trigger(availableNow=True).start())
    qa.awaitTermination()
    assert {r.id for r in spark.read.parquet(out_a).collect()} == \
        {r.id for r in det.anomalies(ev).collect()}

    out_w = scratch_path(spark, "t-win")
    scored = assign(nz.apply(ss.as_event_time(stream)), cs)
    qw = (ss.window_scores(scored, "ts", "1 hour", watermark="1 hour").writeStream
          .format("parquet").option("path", out_w).outputMode("append")
          .option("checkpointLocation", scratch_path(spark, "t-ckpt")).trigger(availableNow=True).start())
    qw.awaitTermination()
    streamed = {r.window_start: (r.n, r.mean_dist) for r in spark.read.parquet(out_w).collect()}
    batch = {r.window_start: (r.n, r.mean_dist)
             for r in ss.window_scores(assign(z, cs), "ts", "1 hour").collect()}
    assert streamed, "closed windows are emitted"
    for k, (n, m) in streamed.items():
        assert batch[k][0] == n and batch[k][1] == pytest.approx(m, rel=1e-12)


def test_snapshot_versions(spark):
    root = scratch_path(spark, "t-snap")
    rep = spark.createDataFrame([(0, "a", 1)], REPORT_JSON_SCHEMA)
    ss.write_snapshot(rep, root, 0)
    ss.write_snapshot(rep.withColumn("count", F.lit(5).cast("long")), root, 1)
    latest = ss.read_latest_snapshot(spark, root, REPORT_JSON_SCHEMA).collect()
    assert [(r.cluster, r.label, r["count"]) for r in latest] == [(0, "a", 5)]
    run = ss.snapshot_writer(lambda b: b, root)
    run(rep.withColumn("count", F.lit(9).cast("long")), 2)
    assert ss.read_latest_snapshot(spark, root, REPORT_JSON_SCHEMA).first()["count"] == 9


def test_restart_resumes_from_checkpoint_and_state(spark):
    pts = fx.embedding_points(spark, SF_SMALL)
    init = CenterSet.from_df(fx.given_centers(spark, SF_SMALL))
    tagged = pts.withColumn("_p", sm.split_index("id", (1, 1, 1, 1), 3))

    def write(src, parts):
        for i in parts:
            tagged.where(F.col("_p") == i).drop("_p").coalesce(1).write.parquet(f"{src}/{i}")

    def run(src, state, ckpt):
        skm = StreamingKMeans(spark, state, init, initial_weight=10.0, decay=0.9)
        q = skm.start(ss.file_stream(spark, f"{src}/*", pts.schema, max_files_per_trigger=1), ckpt, {"availableNow": True})
        q.awaitTermination()
        return skm

    # one uninterrupted run over four files
    src1 = scratch_path(spark, "t-src")
    write(src1, range(4))
    whole = run(src1, scratch_path(spark, "t-state"), scratch_path(spark, "t-ckpt"))

    # two files, stop; two more files, a fresh object on the same folders
    src2, state2, ckpt2 = (scratch_path(spark, n) for n in ("t-src", "t-state", "t-ckpt"))
    write(src2, range(2))
    run(src2, state2, ckpt2)
    write(src2, range(2, 4))
    resumed = run(src2, state2, ckpt2)

    a = sorted((r.cluster, tuple(r.center), r.weight) for r in whole.centers().collect())
    b = sorted((r.cluster, tuple(r.center), r.weight) for r in resumed.centers().collect())
    assert [x[0] for x in a] == [x[0] for x in b]
    np.testing.assert_allclose([x[1] for x in a], [x[1] for x in b], rtol=1e-12, atol=1e-12)
    np.testing.assert_allclose([x[2] for x in a], [x[2] for x in b], rtol=1e-12)
    assert resumed.metrics().count() == 4


def test_snapshot_without_commit_marker_is_skipped(spark):
    root = scratch_path(spark, "t-snap")
    rep = spark.createDataFrame([(0, "a", 1)], REPORT_JSON_SCHEMA)
    ss.write_snapshot(rep, root, 1)
    # a version whose job did not commit: files without the _SUCCESS marker
    (rep.withColumn("count", F.lit(7).cast("long")).write
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        .mode("overwrite").json(f"{root}/v=2"))
    assert ss.read_latest_snapshot(spark, root, REPORT_JSON_SCHEMA).first()["count"] == 1
