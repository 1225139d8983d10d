"""The registered sweeps fit every k and run of the reference, in Spark and in SQL."""

import importlib
import re

import numpy as np
import pytest

from clusterlens.operators import kmeans as km

WHOLE = {
    "k_sweep_entropy": range(30, 161, 10),
    "k_sweep_mixed": range(30, 161, 10),
    "k_sweep_raw": range(30, 101, 10),
    "k_sweep_zscore": range(60, 121, 20),
}
RUNS = 10


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """150 order lines and their orders."""
    rng = np.random.default_rng(5)
    at = str(tmp_path_factory.mktemp("sweep"))
    lines = [(i // 3, i % 3, p, p % 7, float(q), "ANR"[q % 3], "FO"[q % 2],
              c / 100, d / 100, t / 100)
             for i, (p, q, c, d, t) in enumerate(zip(*(rng.integers(0, n, 150).tolist() for n in (900, 50, 9_000_000, 11, 9))))]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, "
                                 "l_quantity double, l_returnflag string, l_linestatus string, l_extendedprice double, "
                                 "l_discount double, l_tax double").write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame([(i, f"{i % 5 + 1}-PRIORITY", "FOP"[i % 3]) for i in range(50)],
                          "o_orderkey long, o_orderpriority string, o_orderstatus string"
                          ).write.parquet(f"{at}/orders.parquet")
    return at


@pytest.mark.parametrize("name", WHOLE)
def test_sweep_fits_every_k_and_run(spark, tables, name, monkeypatch):
    fitted = []

    def seen(vec, runs, *a):
        fitted.extend((r.k, r.seed) for r in runs)
        width = km.kr.shape_of(vec).width
        return [km.kr.Fitted(r, np.zeros((1, width)), 0.0, 0.0, 1, 1) for r in runs]
    monkeypatch.setattr(km.kr, "fit_runs", seen)
    rows = importlib.import_module("__spark_entry__").queries()[name](spark, tables)
    want = [(k, seed) for k in WHOLE[name] for seed in range(1, RUNS + 1)]
    assert fitted == want
    assert [r.k for r in rows.orderBy("k").collect()] == list(WHOLE[name])


@pytest.mark.parametrize("name", WHOLE)
def test_sql_twin_has_every_k_and_run(name):
    sql = importlib.import_module("__spark_entry__").oracle_sql()[name]
    runs = re.search(r"run\(r, k, seed\) AS \(VALUES (.*?)\)\s*,\s*\n", sql).group(1)
    found = [tuple(map(int, x)) for x in re.findall(r"\(\d+, (\d+), (\d+)\)", runs + ")")]
    assert found == [(k, seed) for k in WHOLE[name] for seed in range(1, RUNS + 1)]
