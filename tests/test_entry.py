import importlib

from conftest import SF_CHECK


def test_entry_runs_with_stable_schema(spark):
    e = importlib.import_module("__spark_entry__")
    df = e.entry(spark)
    assert df.columns == ["cluster", "label", "count"]
    assert df.count() > 0


def test_every_query_is_sql_or_row_checked():
    from clusterlens.plans.catalog import ROW_CHECKED
    from clusterlens.plans.catalog import QUERIES
    e = importlib.import_module("__spark_entry__")
    assert set(QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(QUERIES) - ROW_CHECKED == set(e.oracle_sql()) & set(QUERIES)


def test_sql_twins_agree_on_a_sample_of_queries(spark):
    """The driver's check, run here for a few fast queries."""
    import duckdb
    e = importlib.import_module("__spark_entry__")
    con = duckdb.connect()
    for t in ("embeddings", "events", "lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    for name in ("label_makeup", "cluster_report", "window_score", "report_group_small"):
        s = e.queries()[name](spark, SF_CHECK)
        srows = sorted(tuple(r[c] for c in sorted(s.columns)) for r in s.collect())
        res = con.execute(e.oracle_sql()[name])
        cols = [d[0] for d in res.description]
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        drows = sorted(tuple(r[i] for i in order) for r in res.fetchall())
        assert sorted(s.columns) == sorted(cols), name
        assert srows == drows, name
