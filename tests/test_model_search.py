from clusterlens.plans import fixtures as fx
from clusterlens.plans import model_search as ms
from conftest import SF_SMALL


def test_sweeps_return_one_score_per_k(spark):
    lines = fx.record_lines(spark, SF_SMALL)
    for fn in (ms.search_k_raw, ms.search_k_zscore, ms.search_k_mixed, ms.search_k_entropy):
        rows = fn(lines, fx.RECORD_LAYOUT, ks=(2, 3), runs=1).orderBy("k").collect()
        assert [r.k for r in rows] == [2, 3]
        assert all(r.score >= 0 for r in rows)
    basic = ms.search_k_basic(lines, fx.RECORD_LAYOUT, ks=(2,)).collect()
    assert basic[0].k == 2


def test_list_anomalies_flags_fewer_than_n(spark):
    lines = fx.record_lines(spark, SF_SMALL)
    out = ms.list_anomalies(lines, fx.RECORD_LAYOUT, k=4, runs=1, n=30)
    rows = out.collect()
    assert 0 < len(rows) <= 29
    assert all(r.line.endswith(r.label) for r in rows)
