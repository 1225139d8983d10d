"""The pipeline and the registered queries."""

import hashlib

import duckdb
import pytest

import corpus_pipeline
from clusterlens.llm import bpe, decontaminate, near_dedup, quality_rules
from clusterlens.llm.common import staged
from clusterlens.llm.queries import ORACLE, QUERIES
from llm_fixtures import documents, edges, empty  # noqa: F401

SF = "/root/testdata/sf0.01"


def test_stages_follow_from_one_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = staged(stage(spark, docs, SF), "test-stage")
        seen[name] = (docs, out)
        if name != "bpe":
            assert out.columns == columns
            docs = out
    before, after = seen["quality_rules"]
    judged = {r.doc_id: r.qr_kept for r in quality_rules.judge(before).collect()}
    assert {r.doc_id for r in after.collect()} == {i for i, k in judged.items() if k}
    before, after = seen["near_dedup"]
    classes = {r.doc_id: r.class_id for r in near_dedup.classes(before).collect()}
    assert {r.doc_id for r in after.collect()} == set(classes.values())
    before, after = seen["decontaminate"]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    hit = {r.doc_id: bool(r.marks) for r in decontaminate.find(before, bench).collect()}
    text = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert (r.text == text[r.doc_id]) != hit[r.doc_id] and r.n_chars == len(r.text)
    assert decontaminate.find(after, bench).where("marks is not null").count() == 0
    before, after = seen["bpe"]
    vocab = bpe.Vocabulary(bpe.TOKENIZER)
    enc = bpe.Encoder(vocab)
    want = {r.doc_id: len(enc.encode(r.text)) for r in before.collect()}
    assert {r.doc_id: r.n_tokens for r in after.collect()} == want
    ran = {(r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert ran == {(r.doc_id, r.ids_sha256) for r in after.collect()}


def test_stages_take_odd_and_empty_tables(spark, edges, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
        assert stage(spark, edges, SF).count() <= 8


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twins_agree(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == sorted(res.fetchall())
