import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from clusterlens.functions import nearest as nr
from clusterlens.functions.nearest import CenterSet, assign, nearest_numpy
from clusterlens.functions.vectors import distance
from clusterlens.plans import fixtures as fx
from conftest import SF_SMALL


def brute(x, c):
    d = np.sqrt(((x[:, None, :] - c[None, :, :]) ** 2).sum(-1))
    return d.argmin(1), d.min(1)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 12), st.integers(1, 9),
       st.sampled_from([1e-3, 1.0, 1e6, 1e9]), st.integers(0, 10_000))
def test_numpy_kernel_is_exact_argmin(m, k, d, scale, seed):
    rng = np.random.RandomState(seed)
    x = rng.randn(m, d) * scale + scale
    c = rng.randn(k, d) * scale + scale
    b, dist = nearest_numpy(x, c)
    eb, ed = brute(x, c)
    np.testing.assert_allclose(dist, ed, rtol=1e-12, atol=0)
    # the winner is at the exact minimum distance (ties may pick any minimiser)
    assert np.all(np.isclose(ed[np.arange(m)], dist, rtol=1e-12))


def test_duplicate_centres_lowest_id_wins():
    x = np.array([[1.0, 1.0]])
    c = np.array([[0.0, 0.0], [0.0, 0.0], [5.0, 5.0]])
    b, _ = nearest_numpy(x, c)
    assert b[0] == 0


def test_arrow_equals_hof_on_embeddings(spark):
    pts = fx.embedding_points(spark, SF_SMALL)
    cs = CenterSet.from_df(fx.given_centers(spark, SF_SMALL))
    a = {r.id: (r.cluster, r.dist) for r in assign(pts, cs, method="arrow").collect()}
    h = {r.id: (r.cluster, r.dist) for r in assign(pts, cs, method="hof").collect()}
    assert a.keys() == h.keys()
    for k in a:
        assert a[k][0] == h[k][0]
        assert a[k][1] == pytest.approx(h[k][1], rel=1e-12)


def test_invalid_rows_get_null(spark):
    df = spark.createDataFrame(
        [(1, [0.0, 0.0]), (2, None), (3, [1.0]), (4, [float("nan"), 1.0]), (5, [9.0, 9.0])],
        "id int, features array<double>")
    cs = CenterSet.from_arrays([7, 3], [[10.0, 10.0], [0.0, 0.0]])
    for method in ("arrow", "hof"):
        out = {r.id: (r.cluster, r.dist) for r in assign(df, cs, method=method).collect()}
        assert out[1] == (3, 0.0)
        assert out[5][0] == 7 and out[5][1] == pytest.approx(np.sqrt(2))
        assert out[2] == (None, None) and out[3] == (None, None) and out[4] == (None, None)


def test_block_split_matches_single_block(spark, monkeypatch):
    pts = fx.embedding_points(spark, SF_SMALL)
    cs = CenterSet.from_df(fx.given_centers(spark, SF_SMALL))
    one = {r.id: (r.cluster, r.dist) for r in assign(pts, cs).collect()}
    monkeypatch.setattr(nr, "BLOCK_VALUES", 64 * 3)  # 3 centres per block
    many = {r.id: (r.cluster, r.dist) for r in assign(pts, cs).collect()}
    assert one == many


def test_centre_size_check(spark, monkeypatch):
    monkeypatch.setattr(nr, "MAX_CENTER_VALUES", 10)
    with pytest.raises(ValueError):
        CenterSet.from_df(fx.given_centers(spark, SF_SMALL))


def test_distance_rejects_unequal_widths(spark):
    df = spark.createDataFrame([([0.0, 3.0], [4.0, 0.0]), ([1.0], [1.0, 2.0])],
                               "a array<double>, b array<double>")
    out = [r.d for r in df.select(distance("a", "b").alias("d")).collect()]
    assert out[0] == pytest.approx(5.0) and out[1] is None


def test_udf_runs_once_per_row_in_plan(spark, capsys):
    """A filter on the kernel's output must not duplicate the kernel."""
    pts = fx.embedding_points(spark, SF_SMALL)
    a = assign(pts, fx.given_centers(spark, SF_SMALL)).where(F.col("cluster").isNotNull())
    a.explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1


def test_one_broadcast_per_centre_set_and_release(spark):
    from clusterlens.functions.nearest import CenterSet, assign
    cs = CenterSet.from_arrays([0, 1], [[0.0], [9.0]])
    df = spark.createDataFrame([([1.0],), ([8.0],)], "features array<double>")
    assert [r.cluster for r in assign(df, cs).collect()] == [0, 1]
    held = cs.broadcasts(spark.sparkContext)
    assert [r.cluster for r in assign(df, cs).collect()] == [0, 1]
    assert cs.broadcasts(spark.sparkContext) is held
    cs.release()
    assert [r.cluster for r in assign(df, cs).collect()] == [0, 1]
    cs.release()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60), st.integers(1, 90), st.integers(1, 5), st.sampled_from([1e-3, 1.0, 1e6]),
       st.integers(1, 12), st.booleans(), st.integers(0, 10_000))
def test_balls_of_centres_equal_comparing_all(m, k, d, scale, balls, lattice, seed):
    """Also on a lattice, where many centres are repeated and many distances tie."""
    rng = np.random.RandomState(seed)
    draw = (lambda n: rng.randint(0, 3, (n, d)) * scale) if lattice else (lambda n: rng.randn(n, d) * scale)
    x, c = draw(m), draw(k)
    b, dist = nr.nearest_in_balls(x, nr.CenterBalls(c, balls))
    diff = x[:, None, :] - c[None, :, :]
    want = np.einsum("ikd,ikd->ik", diff, diff).argmin(axis=1)
    np.testing.assert_array_equal(b, want)
    np.testing.assert_array_equal(dist, nearest_numpy(x, c)[1])


@pytest.mark.parametrize("k, share", [(130, 1.2), (5_000, 0.3)])
def test_distance_counts_fall_with_many_centres(spark, k, share):
    pts = fx.order_points(spark, SF_SMALL)
    rows = pts.orderBy("rid").limit(k).collect()
    cs = CenterSet.from_arrays(range(len(rows)), [r.features for r in rows])
    all_, balls = (assign(pts, c, method=m) for c, m in ((cs, "arrow"), (cs, "balls")))
    assert sorted(map(tuple, all_.select("rid", "cluster", "dist").collect())) == sorted(
        map(tuple, balls.select("rid", "cluster", "dist").collect()))
    n = nr.distance_counts(pts, cs).first()
    assert n.n_rows == pts.count() and n.n_pairs == n.n_rows * len(rows)
    assert n.n_compared < share * n.n_pairs


def test_balls_on_odd_rows_and_an_empty_table(spark):
    df = spark.createDataFrame(
        [(1, [0.0, 0.0]), (2, None), (3, [1.0]), (4, [float("nan"), 1.0]), (5, [1e308, -1e308]), (6, [9.0, None])],
        "id int, features array<double>")
    cs = CenterSet.from_arrays([7, 3, 5], [[10.0, 10.0], [0.0, 0.0], [0.0, 0.0]])
    out = {r.id: (r.cluster, r.dist) for r in assign(df.where("id <> 5"), cs, method="balls").collect()}
    assert out == {1: (3, 0.0), 2: (None, None), 3: (None, None), 4: (None, None), 6: (None, None)}
    assert assign(df.limit(0), cs, method="balls").collect() == []
    assert nr.distance_counts(df.limit(0), cs).first() == (0, 0, 0)
