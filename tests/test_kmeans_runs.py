"""Batched k-means runs against plain numpy, and their independence of layout."""

from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from clusterlens.operators import evaluate as ev
from clusterlens.operators import kmeans as km
from clusterlens.operators import kmeans_runs as kr
from clusterlens.plans import fixtures as fx
from conftest import SF_SMALL


def frame(spark, x, labels=None):
    rows = [(i, [float(v) for v in r] if r is not None else None,
             None if labels is None else labels[i]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, features array<double>, label string")


def blobs(seed, n=400, k=5, d=3):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((k, d))[rng.integers(0, k, n)] * 8 + rng.standard_normal((n, d))


def plain_lloyd(x, centers, tol, max_iter):
    c = centers.copy()
    for step in range(1, max_iter + 1):
        near = ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1)
        new = np.array([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(len(c))])
        moved = np.sqrt(((new - c) ** 2).sum(1)).max()
        c = new
        if moved <= tol:
            break
    return c, step


@pytest.mark.parametrize("id_col", [None, "id"])
def test_centres_do_not_depend_on_the_layout(spark, id_col):
    x = np.vstack([blobs(1), np.repeat(blobs(2, 3), 150, axis=0)])   # half of the rows are copies
    df = frame(spark, x)
    fits = [km.fit_best(df.repartition(n), 6, runs=3, id_col=id_col) for n in (1, 3, 200)]
    for other in fits[1:]:
        assert (fits[0].centers.matrix == other.centers.matrix).all()
        assert (fits[0].cost, fits[0].seed) == (other.cost, other.seed)


def test_runs_together_equal_runs_apart(spark):
    vec = kr.weighted_points(frame(spark, blobs(3))).persist()
    runs = [kr.Run(2, 7), kr.Run(5, 1), kr.Run(5, 2), kr.Run(9, 1)]
    together = kr.fit_runs(vec, runs, 1e-6, 20, 3)
    for run, fit in zip(runs, together):
        alone = kr.fit_runs(vec, [run], 1e-6, 20, 3)[0]
        assert fit.run == run and (fit.centers == alone.centers).all()
        assert (fit.cost, fit.iterations) == (alone.cost, alone.iterations)
    vec.unpersist()


def test_iterations_equal_numpy_lloyd(spark):
    x = blobs(4, 300, 4, 2)
    vec = kr.weighted_points(frame(spark, x)).persist()
    shape = kr.shape_of(vec)
    rng = np.random.default_rng(0)
    starts = [x[rng.choice(len(x), k, replace=False)] for k in (2, 4, 8)] + [np.array([[0.0, 0], [1e6, 1e6]])]
    for start, (got, steps) in zip(starts, kr.iterate(vec, shape, starts, 1e-6, 20)):
        want, n = plain_lloyd(x, start, 1e-6, 20)
        np.testing.assert_allclose(got, want, rtol=1e-12, atol=1e-12)
        assert steps == n
    for s, c in zip(kr.scan(vec, shape, starts), starts):
        d2 = ((x[:, None] - c[None]) ** 2).sum(-1)
        assert s.cost == pytest.approx(d2.min(1).sum(), rel=1e-12)
        assert s.distance == pytest.approx(np.sqrt(d2.min(1)).sum(), rel=1e-12)
        assert s.rows.tolist() == np.bincount(d2.argmin(1), minlength=len(c)).tolist()
    vec.unpersist()


def test_copies_weigh_what_they_are(spark):
    x = blobs(5, 60, 3, 2)
    copies = np.random.default_rng(1).integers(1, 40, len(x))
    many = frame(spark, np.repeat(x, copies, axis=0)).repartition(7)
    vec = kr.weighted_points(many).persist()
    assert vec.count() == len(x) and kr.shape_of(vec).n == copies.sum()
    fit = kr.fit_runs(vec, [kr.Run(3, 1)], 0.0, 50, 2)[0]
    d2 = ((x[:, None] - fit.centers[None]) ** 2).sum(-1)
    near = d2.argmin(1)
    for j in range(3):
        mine = near == j
        np.testing.assert_allclose(fit.centers[j], np.average(x[mine], axis=0, weights=copies[mine]), rtol=1e-12)
    assert fit.cost == pytest.approx((d2.min(1) * copies).sum(), rel=1e-12)
    vec.unpersist()


def test_passes_do_not_grow_with_the_number_of_k(spark, monkeypatch):
    calls = Counter()
    for name in ("scan", "_least"):
        original = getattr(kr, name)

        def counted(*a, _f=original, _n=name, **kw):
            calls[_n] += 1
            return _f(*a, **kw)
        monkeypatch.setattr(kr, name, counted)
    df = frame(spark, blobs(6))
    seen = []
    for ks in ((3,), (2, 3, 4, 5, 6)):
        calls.clear()
        km.k_sweep(df, ks, runs=2).collect()
        assert calls["_least"] == 6                # first centres and five rounds
        seen.append(calls["scan"])
    assert all(n <= 1 + 20 + 1 for n in seen)      # weights, iterations, costs


def test_sweep_scores_equal_one_fit_at_a_time(spark):
    pts = fx.embedding_points(spark, SF_SMALL)
    for how in ("distance", "entropy"):
        together = {r.k: r.score for r in km.k_sweep(pts, (2, 5), how, runs=2).collect()}
        for k, score in together.items():
            assert score == pytest.approx(km.tuned_score(pts, k, runs=2, how=how), rel=1e-9)


def test_makeups_of_several_models(spark):
    x = blobs(7, 200, 4, 2)
    labels = [None if i % 7 == 0 else "ab"[i % 2] for i in range(200)]
    rows = [*x, None, [1.0], [float("nan"), 0.0]]
    df = frame(spark, rows, labels + ["a"] * 3).repartition(5)
    sets = {3: x[:3], 6: x[:6]}
    got = {(r.k, r.cluster, r.label): r["count"] for r in kr.makeups(df, sets).collect()}
    want = Counter((k, int(n), lab) for k, c in sets.items()
                   for n, lab in zip(((x[:, None] - c[None]) ** 2).sum(-1).argmin(1), labels))
    assert got == want
    scores = {r.k: r.entropy_score for r in ev.entropy_score(kr.makeups(df, sets), by="k").collect()}
    for k in sets:
        one = kr.makeups(df, {k: sets[k]}).drop("k")
        assert scores[k] == pytest.approx(ev.entropy_score(one).first().entropy_score, rel=1e-12)


def test_limbs_add_up_exactly():
    rng = np.random.default_rng(8)
    x = np.concatenate((rng.standard_normal(1000) * 10.0 ** rng.integers(-6, 6, 1000), [0.0, -1e6, 999999.9]))
    e = int(np.frexp(np.abs(x).max())[1])
    high, low = kr.limbs(x, e)
    assert np.abs(kr.joined(high, low, e) - x).max() <= 2.0 ** (e - 2 * kr.LIMB)
    for order in (slice(None), slice(None, None, -1)):
        h, lo = int(high[order].sum()), int(low[order].sum())
        total = (Fraction(h) * 2 ** kr.LIMB + lo) * Fraction(2) ** (e - 2 * kr.LIMB)
        assert abs(total - sum(map(Fraction, x.tolist()))) <= len(x) * Fraction(2) ** (e - 2 * kr.LIMB)


def test_race_draws_by_weight():
    n = 4
    b1, b2 = np.arange(1, n + 1) * 1234567, np.arange(n) * 7654321 + 11
    weight = np.array([0.0, 1.0, 2.0, 5.0])
    won = Counter(int(kr.race(b1, b2, s, "draw", weight).argmin()) for s in range(4000))
    assert won[0] == 0
    for i in (1, 2, 3):
        assert abs(won[i] / 4000 - weight[i] / 8) < 0.03


def test_blocks_of_wide_points_stay_small(spark):
    wide = spark.range(600).selectExpr("id", "transform(sequence(0, 1999), i -> if(i = id, 1.0D, 0.0D)) AS features")
    blocks = kr.packed(kr.weighted_points(wide.coalesce(1), id_col="id")).persist()
    assert blocks.selectExpr("max(length(f))").first()[0] <= 8 * kr.BLOCK_VALUES
    assert blocks.selectExpr("sum(points)", "sum(rows)").first()[:] == (600, 600)
    assert kr.fit_runs(blocks, [kr.Run(2, 1)], 1e-6, 5, 1)[0].n == 600
    blocks.unpersist()


def test_odd_inputs(spark):
    two = frame(spark, [[1.0, 2.0]] * 5 + [[3.0, 4.0]] + [None, [float("nan"), 1.0]])
    r = km.fit(two, k=4)
    assert sorted(map(tuple, r.centers.matrix)) == [(1.0, 2.0), (3.0, 4.0)] and r.cost == 0
    assert km.fit(frame(spark, [[0.0]] * 3), k=2).centers.matrix.tolist() == [[0.0]]
    with pytest.raises(ValueError, match="no points"):
        km.fit(frame(spark, []), k=2)
    with pytest.raises(ValueError, match="widths"):
        km.fit(frame(spark, [[1.0], [1.0, 2.0]]), k=1)
    assert km.fit(frame(spark, [[2.0 ** 40, 1.0], [0.0, 1.0]]), k=2).cost == 0


def test_one_column_points(spark):
    x = [[0.0], [0.1], [10.0], [10.2], [20.0]]
    r = km.fit_best(frame(spark, x), 3, runs=5)
    assert sorted(round(v, 6) for v in r.centers.matrix[:, 0]) == [0.05, 10.1, 20.0]


@pytest.mark.parametrize("top", [2 ** 20, 2 ** 60])
@pytest.mark.parametrize("groups", [1, 5, 40])
def test_group_sums_are_exact_whatever_the_path(top, groups):
    rng = np.random.default_rng(groups)
    values = rng.integers(-top // 4096, top // 4096, (3000, 4)) | 1
    group = rng.integers(0, groups, 3000)
    group[group == 3] = 0                                   # one without rows
    want = [[sum(int(v) for v in values[group == g, c]) for c in range(4)] for g in range(groups)]
    assert kr.group_sums(values)(group, groups).tolist() == want
    assert kr.group_sums(values[:0])(group[:0], groups).tolist() == [[0] * 4] * groups


@pytest.mark.parametrize("k", [1, 2, 17, 101, 400])
def test_nearest_of_a_middling_number_of_centres_is_exact(k):
    from clusterlens.functions.nearest import _exact_argmin, nearest_numpy
    rng = np.random.default_rng(k)
    x = rng.integers(0, 4, (2000, 3)).astype(np.float64)        # many ties
    c = np.vstack((rng.integers(0, 4, (k - k // 2, 3)), x[:k // 2])).astype(np.float64)
    for scale in (1.0, 1e-100, 1e150):
        near, dist = nearest_numpy(x * scale, c * scale)
        want = _exact_argmin(x, c)
        if scale == 1.0:
            assert (near == want).all()
        np.testing.assert_allclose(dist, np.sqrt(((x - c[want]) ** 2).sum(axis=1)) * scale, rtol=1e-12)
