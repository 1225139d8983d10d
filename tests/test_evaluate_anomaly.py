import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from clusterlens.functions.nearest import CenterSet, assign
from clusterlens.operators import anomaly as an
from clusterlens.operators import evaluate as ev
from clusterlens.operators import kmeans as km
from clusterlens.operators.report import cluster_report
from clusterlens.plans import fixtures as fx
from conftest import SF_SMALL


def makeup(spark, rows):
    return spark.createDataFrame(rows, "cluster int, label string, count long")


def test_entropy_hand_cases(spark):
    mk = makeup(spark, [(0, "a", 1), (0, "b", 1), (1, "a", 2)])
    e = {r.cluster: r.entropy for r in ev.cluster_entropy(mk).collect()}
    assert e[0] == pytest.approx(math.log(2)) and e[1] == pytest.approx(0.0, abs=1e-15)
    s = ev.entropy_score(mk).first()
    assert s.entropy_score == pytest.approx(math.log(2) / 2) and s.n == 4


def test_zero_counts_are_ignored(spark):
    mk = makeup(spark, [(0, "a", 3), (0, "b", 0)])
    assert ev.cluster_entropy(mk).first().entropy == pytest.approx(0.0, abs=1e-15)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from("abcde"), st.integers(1, 50)),
                min_size=1, max_size=25, unique_by=lambda t: (t[0], t[1])))
def test_entropy_bounds(spark, rows):
    mk = makeup(spark, rows)
    for r in ev.cluster_entropy(mk).collect():
        labels = sum(1 for c, _, _ in rows if c == r.cluster)
        assert -1e-12 <= r.entropy <= math.log(labels) + 1e-12
    pure = all(sum(1 for c2, _, _ in rows if c2 == c) == 1 for c, _, _ in rows)
    score = ev.entropy_score(mk).first().entropy_score
    assert (abs(score) < 1e-12) == pure


def dists(spark, values):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)],
                                 "id int, dist double")


def test_threshold_ties(spark):
    d = dists(spark, [5, 4, 4, 3])
    t = an.distance_threshold(d, n=2).first().threshold
    assert t == 4.0
    flagged = an.flag(d, t).where("anomalous").collect()
    assert [r.dist for r in flagged] == [5.0]


def test_threshold_short_input(spark):
    d = dists(spark, [2, 1])
    assert an.distance_threshold(d, n=100).first().threshold == 1.0
    assert [r.dist for r in an.flag(d, an.threshold_value(d, 100)).where("anomalous").collect()] == [2.0]


def test_threshold_empty_input(spark):
    d = dists(spark, [])
    assert an.distance_threshold(d, n=100).first().threshold is None
    assert an.flag(d, an.threshold_value(d, 100)).where("anomalous").count() == 0


def test_detector_flags_at_most_n_minus_one(spark):
    pts = fx.embedding_points(spark, SF_SMALL)
    det = an.AnomalyDetector.build(pts, fx.given_centers(spark, SF_SMALL), None, n=50)
    flagged = det.anomalies(pts).count()
    assert flagged <= 49
    scored = det.score(pts)
    assert scored.where("dist > {}".format(det.threshold)).count() == flagged


def test_report_matches_separate_scores(spark):
    a = assign(fx.embedding_points(spark, SF_SMALL), fx.given_centers(spark, SF_SMALL))
    rep = cluster_report(a, n=100).collect()
    ent = {r.cluster: r.entropy for r in ev.cluster_entropy(ev.label_makeup(a)).collect()}
    md = {r.cluster: r.mean_dist for r in ev.distance_by_cluster(a).collect()}
    t = an.distance_threshold(a, 100).first().threshold
    flagged = an.flag(a, t)
    per = {}
    for r in flagged.where("anomalous").collect():
        per[r.cluster] = per.get(r.cluster, 0) + 1
    for r in rep:
        assert r.entropy == pytest.approx(ent[r.cluster], abs=1e-12)
        assert r.mean_dist == pytest.approx(md[r.cluster], rel=1e-12)
        assert r.anomalies == per.get(r.cluster, 0)
    assert sum(r["count"] for r in rep) == 500


def test_makeup_text_format(spark):
    out = ev.makeup_text(makeup(spark, [(3, "smurf.", 280790)])).first().line
    assert out == "3" + "smurf.".rjust(18) + "280790".rjust(8)


def test_lloyd_cost_never_rises(spark):
    pts = fx.embedding_points(spark, SF_SMALL).persist()
    cs = CenterSet.from_df(fx.given_centers(spark, SF_SMALL))

    def cost(c):
        return assign(pts, c).selectExpr("sum(dist * dist) AS s").first().s

    costs = [cost(cs)]
    for _ in range(3):
        cs = km.lloyd(pts, cs, steps=1)
        costs.append(cost(cs))
    pts.unpersist()
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))


def test_lloyd_keeps_empty_cluster_and_matches_numpy(spark):
    pts = spark.createDataFrame([(0, [0.0]), (1, [1.0]), (2, [10.0])], "id int, features array<double>")
    cs = CenterSet.from_arrays([0, 1, 2], [[0.0], [9.0], [100.0]])
    out = km.lloyd(pts, cs, steps=1)
    np.testing.assert_allclose(out.matrix[:, 0], [0.5, 10.0, 100.0])


def test_vector_sums_long_path_equals_unrolled(spark, monkeypatch):
    a = assign(fx.embedding_points(spark, SF_SMALL), fx.given_centers(spark, SF_SMALL))
    one = {r.cluster: (r.n, list(r.sums)) for r in km.vector_sums(a, 64).collect()}
    monkeypatch.setattr(km, "UNROLL_LIMIT", 8)
    two = {r.cluster: (r.n, list(r.sums)) for r in km.vector_sums(a, 64).collect()}
    assert one.keys() == two.keys()
    for c in one:
        assert one[c][0] == two[c][0]
        np.testing.assert_allclose(one[c][1], two[c][1], rtol=1e-12, atol=1e-12)


def test_fit_and_fit_best(spark):
    pts = fx.embedding_points(spark, SF_SMALL)
    r = km.fit(pts, k=3, seed=2)
    assert r.centers.k == 3 and r.centers.dim == 64
    best = km.fit_best(pts, k=3, runs=3, seed=2)
    singles = [km.fit(pts, k=3, seed=s, tol=1e-6, init_steps=5).cost for s in (2, 3, 4)]
    assert best.cost == pytest.approx(min(singles))


def test_sweep_returns_one_row_per_k(spark):
    pts = fx.embedding_points(spark, SF_SMALL)
    rows = km.k_sweep(pts, (2, 4), runs=1).orderBy("k").collect()
    assert [r.k for r in rows] == [2, 4]
    assert all(r.score > 0 for r in rows)


def test_fit_quality_and_determinism(spark):
    pts = fx.embedding_points(spark, SF_SMALL).persist()

    def cost(cs):
        return assign(pts, cs).selectExpr("sum(dist * dist) AS s").first().s

    lloyd_cost = cost(km.lloyd(pts, fx.given_centers(spark, SF_SMALL), steps=5))
    best = km.fit_best(pts, k=10, runs=3, seed=5)
    assert cost(best.centers) <= 1.1 * lloyd_cost
    again = km.fit_best(pts, k=10, runs=3, seed=5)
    np.testing.assert_allclose(best.centers.matrix, again.centers.matrix, rtol=1e-12)
    pts.unpersist()


def test_hot_value_third_of_rows_is_exact(spark):
    """One point value holds a third of the rows, spread over 8 partitions."""
    rng = np.random.RandomState(2)
    cold = rng.randn(2000, 3) * 3
    hot = np.tile([[0.5, 0.5, 0.5]], (1000, 1))
    x = np.vstack([cold, hot])
    labels = ["a" if i % 3 else "b" for i in range(2000)] + ["hot"] * 1000
    df = spark.createDataFrame([(i, labels[i], [float(v) for v in x[i]]) for i in range(len(x))],
                               "id long, label string, features array<double>").repartition(8)
    cs = CenterSet.from_arrays([0, 1, 2], [[0.0, 0.0, 0.0], [5.0, 5.0, 5.0], [-5.0, -5.0, -5.0]])
    d = np.sqrt(((x[:, None, :] - cs.matrix[None]) ** 2).sum(-1))
    near = d.argmin(1)
    a = assign(df, cs)
    mk = {(r.cluster, r.label): r["count"] for r in ev.label_makeup(a).collect()}
    expect = {}
    for c, lab in zip(near, labels):
        expect[(int(c), lab)] = expect.get((int(c), lab), 0) + 1
    assert mk == expect
    rep = cluster_report(a, n=100).collect()
    assert sum(r["count"] for r in rep) == 3000
    step = km.lloyd(df, cs, steps=1)
    for j in range(3):
        if (near == j).any():
            np.testing.assert_allclose(step.matrix[j], x[near == j].mean(0), rtol=1e-10)
    from clusterlens.operators.stats import feature_moments
    m = sorted((r.pos, r.mean, r.std) for r in feature_moments(df).collect())
    np.testing.assert_allclose([v[1] for v in m], x.mean(0), rtol=1e-10)
    np.testing.assert_allclose([v[2] for v in m], x.std(0), rtol=1e-10)


def test_single_k_scores(spark):
    pts = fx.embedding_points(spark, SF_SMALL)
    b = km.basic_score(pts, 3, seed=1)
    t = km.tuned_score(pts, 3, runs=2, seed=1)
    e = km.tuned_score(pts, 3, runs=1, seed=1, how="entropy")
    assert b > 0 and t > 0 and 0 <= e <= math.log(10) + 1e-12
