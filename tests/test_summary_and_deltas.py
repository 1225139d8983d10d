"""One-pass summaries, numbered repeated lines, delta logs and stream windows."""

from collections import Counter, defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from clusterlens.functions.nearest import assign
from clusterlens.operators import anomaly as an
from clusterlens.operators import sample as sm
from clusterlens.operators.report import cluster_report, report_from_flags
from clusterlens.operators.stats import feature_moments
from clusterlens.operators.summary import anomaly_count_of, summarise, threshold_of
from clusterlens.plans import fixtures as fx
from clusterlens.session import scratch_path
from clusterlens.sources.records import numbered_records
from clusterlens.streaming import delta_log as dl
from conftest import SF_SMALL


def scored(spark, rows):
    return spark.createDataFrame(rows, "cluster int, label string, dist double")


@pytest.mark.parametrize("n", [1, 3, 50, 10_000])
def test_report_equals_flagging_every_record(spark, n):
    rng = np.random.default_rng(n)
    rows = [(int(c), None if c == 2 else "ab"[int(v * 10) % 2], float(round(v, 2)))
            for c, v in zip(rng.integers(0, 4, 600), rng.random(600))] + [(None, "a", None), (1, "a", 0.99)] * 3
    df = scored(spark, rows).repartition(6).persist()
    t = an.distance_threshold(df, n).first().threshold
    assert threshold_of(summarise(df, n), n).first().threshold == t

    def key(r):
        return (r.cluster, r.label, r["count"], round(r.entropy, 9), round(r.mean_dist, 9), r.anomalies)
    want = sorted(map(key, report_from_flags(an.flag(df, t)).collect()), key=repr)
    assert sorted(map(key, cluster_report(df, n).collect()), key=repr) == want
    assert anomaly_count_of(df, n).first().anomalies == sum(d is not None and d > t for _, _, d in rows)
    df.unpersist()


def test_records_are_scored_once(spark):
    a = assign(fx.embedding_points(spark, SF_SMALL), fx.given_centers(spark, SF_SMALL))
    for df in (anomaly_count_of(a, 20), summarise(a, 20)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1


def test_summary_of_nothing(spark):
    none = scored(spark, [])
    assert cluster_report(none).collect() == [] and anomaly_count_of(none).first().anomalies == 0


def test_a_split_takes_its_share_of_a_repeated_line(spark):
    lines = ["hot"] * 57_000 + [f"line {i % 4300}" for i in range(43_000)]
    df = spark.createDataFrame([(x,) for x in lines] + [(None,)], "line string")
    got = [{(r.rid, r.line) for r in numbered_records(df.repartition(p)).collect()} for p in (1, 9)]
    assert got[0] == got[1] and len(got[0]) == 100_000
    assert Counter(line for _, line in got[0]) == Counter(lines)
    one, rest = sm.hash_split(numbered_records(df), (0.01, 0.99), 11, "rid")
    hot = one.where("line = 'hot'").count()
    assert abs(hot - 570) < 100 and rest.where("line = 'hot'").count() == 57_000 - hot
    drawn = sm.bootstrap_sample(numbered_records(df), 0.1, 3, "rid").where("line = 'hot'").count()
    assert abs(drawn - 5_700) < 400


def test_delta_log_replay_compaction_and_history(spark):
    log = dl.DeltaLog(spark, scratch_path(spark, "log"), "k string, count long", dl.summed(("k",)), every=3)
    assert log.state().collect() == []
    batches = [["a", "b"], ["a"], ["c"] * 3, [], ["a", "c"], ["b"] * 4, ["d"]]

    def frame(keys):
        return spark.createDataFrame([(k, 1) for k in keys], "k string, count long")

    def state(**kw):
        return {r.k: r["count"] for r in log.state(**kw).collect()}
    for i, keys in enumerate(batches):
        log.append(frame(keys), i)
        if i in (2, 4):
            log.append(frame(keys), i)                  # replayed
        assert state() == Counter(k for b in batches[:i + 1] for k in b)
    assert log.versions("base") == [2, 5]
    for i in range(len(batches) + 1):
        assert state(before=i) == Counter(k for b in batches[:i] for k in b)
    # a delta written but not entered does not count
    frame(["zzz"]).write.parquet(f"{log.root}/delta/v=99")
    assert "zzz" not in state()


def test_stream_moments_under_any_batching(spark):
    pts = fx.embedding_points(spark, SF_SMALL).persist()
    want = {r.pos: r for r in feature_moments(pts, dim=64).collect()}
    for parts in (1, 5):
        m = dl.StreamMoments(spark, scratch_path(spark, "m"), 64, every=2)
        tagged = pts.withColumn("p", sm.split_index("id", (1,) * parts, 3))
        for i in range(parts):
            m.process(tagged.where(F.col("p") == i), i)
        m.process(tagged.where(F.col("p") == 0), 0)      # replay
        for r in m.moments().collect():
            w = want[r.pos]
            assert r.n == w.n and r.mean == pytest.approx(w.mean, rel=1e-10) and r.std == pytest.approx(w.std, rel=1e-10)
    pts.unpersist()


def test_windows_count_late_records(spark):
    t0 = datetime(2024, 1, 1)
    rng = np.random.default_rng(4)
    batches = [[(t0 + timedelta(minutes=int(m)), float(d)) for m, d in
                zip(rng.integers(max(0, 120 * b - 200), 120 * (b + 1), 80), rng.random(80))] for b in range(5)]
    batches[2].append((None, 1.0))
    batches[3].append((t0 + timedelta(minutes=470), None))
    s = dl.WindowScores(spark, scratch_path(spark, "w"), "timestamp_ntz", delay="30 minutes", every=2)
    n, late, sums, latest = Counter(), Counter(), defaultdict(list), None
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "ts timestamp_ntz, dist double")
        s.process(df, i)
        if i == 3:
            s.process(df, i)                             # replay
        mark = latest - timedelta(minutes=30) if latest else None
        for ts, d in rows:
            if ts is None:
                continue
            start = ts.replace(minute=0, second=0)
            if mark and start + timedelta(hours=1) <= mark:
                late[start] += 1
            else:
                n[start] += 1
                if d is not None:
                    sums[start].append(d)
        latest = max([ts for ts, _ in rows if ts] + ([latest] if latest else []))
    got = {datetime.fromisoformat(r.window_start): r for r in s.scores().collect()}
    assert sum(late.values()) > 20 and got.keys() == n.keys() | late.keys()
    for w, r in got.items():
        assert (r.n, r.late) == (n[w], late[w])
        assert r.mean_dist == (pytest.approx(np.mean(sums[w])) if sums[w] else None)
        assert r.closed == (w + timedelta(hours=1) <= latest - timedelta(minutes=30))
    assert sum(r.n + r.late for r in got.values()) == sum(ts is not None for b in batches for ts, _ in b)
