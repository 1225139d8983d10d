import math
import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import DOCUMENTS, documents, edge_rows, edges, empty  # noqa: F401

from clusterlens.llm import collocations as co
from clusterlens.llm import embedding_whitening as ew
from clusterlens.llm import language_id as li

SF = "/root/testdata/sf0.01"


# --- collocations -----------------------------------------------------------------

def plain_collocations(rows, support, top):
    """rows: (lang, text); the contract in plain Python."""
    import re
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, min(4, len(w) - i) + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {p: c for p, c in f.items() if c >= support and len(p[1]) > 1}
    out = {}
    for (lang, p), a in cand.items():
        if any(lang == other and len(q) > len(p) and 100 * c >= 80 * a
               and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
               for (other, q), c in cand.items()):
            continue
        cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append(
            (-score, -a, " ".join(p).encode(), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    return {(lang, i, r[2].decode(), *r[3:]) for lang, rs in out.items()
            for i, r in enumerate(sorted(rs)[:top], 1)}


def prose(seed, docs=120):
    rng = random.Random(seed)
    words = ["Of", "the", "new", "york", "stock", "é", "exchange", "a", "x y", "b", "*", "\U0001f642"]
    rows = []
    for _ in range(docs):
        text = ""
        for _ in range(rng.randrange(60)):
            text += rng.choice(["new york stock exchange", "the the the", *words])
            text += rng.choice([" ", "  ", "\t", " ", ", ", ".", "\n", " ", "\x0b", "\x85"])
        rows.append((rng.choice(["en", "fr", None]), text))
    return rows


@pytest.mark.parametrize("seed,support,top", [(1, 3, 1000), (2, 8, 7), (3, 2, 50)])
def test_collocations_match_plain_python(spark, monkeypatch, seed, support, top):
    rows = prose(seed) + [(None, None), ("en", ""), ("de", "one.two,three"), ("en", "A" * 5000)]
    df = spark.createDataFrame([(i, t, g, "n") for i, (g, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, n string").repartition(3)
    want = plain_collocations(rows, support, top)
    for filtered in (True, False):
        got = {tuple(r) for r in co.collocations(df, top, support, filtered=filtered).select(
            "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}
        assert got == want


def test_windows_do_not_depend_on_blocks(monkeypatch):
    rows = prose(4, 40) + [("en", None), (None, "alone"), ("en", "wordwithoutend")]
    batch = pa.RecordBatch.from_pydict({"lang": [g or "und" for g, _ in rows], "text": [t for _, t in rows]})

    def counted(size):
        monkeypatch.setattr(co, "BLOCK", size)
        total = Counter()
        for lang, text in co.blocks(batch.slice(1)):
            out = co.window_counts(lang, text, None)
            for r in out.to_pylist() if out is not None else ():
                total[tuple(v for k, v in r.items() if k != "n")] += r["n"]
        return total
    whole = counted(1 << 30)
    assert counted(1) == whole and counted(500) == whole and sum(whole.values()) > 500


def test_collocations_edges(spark, edges, empty):  # noqa: F811
    assert co.collocations(empty).collect() == []
    got = co.collocations(edges, support=2).collect()
    assert [(r["phrase"], r["a"]) for r in got if r["lang"] == "en"] == [("a b", 2)]


def test_filter_counters_saturate(spark):
    # 300 occurrences in one document, one in each of 300 others: all counted
    rows = [(0, "far away " * 300, "en")] + [(i, "near by", "en") for i in range(1, 301)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    got = {r["phrase"]: r["a"] for r in co.collocations(df, support=299).collect()}
    assert got["near by"] == 300 and "far away" not in got       # inside 'far away far away'
    assert got["far away far away"] == 299


# --- language ---------------------------------------------------------------------

def plain_subwords(text):
    """The n-grams of a text as strings, a word's borders written '_'."""
    out, word = Counter(), ""
    words = []
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            words.append(word)
            word = ""
    for w in words:
        w = "_" + w + "_"
        for n in (1, 2, 3):
            for i in range(len(w) - n + 1):
                g = w[i:i + n]
                if g.strip("_") and "_" not in g[1:-1]:
                    out[g] += 1
    return out


def test_subwords_match_plain_python():
    values = ["Der Fluß, der -- fließt", "", "a", " 1 2 ", "Ünï code İ x9y", "ab\0cd", "é🙂è"]
    bucket, own = li.subwords(values, li.Letters())
    for i, v in enumerate(values):
        assert (own == i).sum() == sum(plain_subwords(v).values()), v
    # equal subwords fall into equal buckets, whatever stands beside them
    one = {}
    for i, v in enumerate(values):
        alone = li.subwords([v], li.Letters())[0]
        assert sorted(alone) == sorted(bucket[own == i])
        one[v] = alone
    assert len(set(one["a"].tolist())) == 4        # a, _a, a_, _a_


def test_descent_follows_the_gradient():
    rng = np.random.default_rng(0)
    rows = [rng.integers(0, 40, 30) + 40 * (i % 3) for i in range(90)]
    y = np.arange(90) % 3
    w, b = li.descend(rows, y, 3, li.Limits(epochs=30))
    z = np.array([w[r].mean(axis=0) for r in rows]) + b
    assert (z.argmax(axis=1) == y).all()
    assert not w[200:].any()                        # never seen: says nothing


def test_rejection_limit_by_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(50):
        score = rng.integers(0, 20, 60) / 20
        right = rng.random(60) < 0.2 + 0.8 * score
        limit = li.rejection_limit(score, right, 0.1)
        fine = [s for s in sorted(set(score)) if (~right[score >= s]).mean() <= 0.1]
        assert limit == (fine[0] if fine else 1.0)


def test_language_held_out(spark):
    out = li.query(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    got = out.merge(docs, on="doc_id")
    assert len(out) == 1000 and got.score.between(0, 1).all()
    import zlib
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.98
    assert held.rejected.mean() < 0.05


def test_language_edges(spark, documents, edges, empty):  # noqa: F811
    rows = [(i, t, g, "s", 1) for i in range(40) for g, t in
            (("en", "the cat and the dog"), ("de", "die Katze und der Hund"))]
    model = li.train(documents(rows),
                     li.held_out())
    wide = edges.withColumn("score", edges["n_chars"]).withColumn("lang_pred", edges["lang"])
    got = li.predict(wide, model).collect()
    assert len(got) == edges.count()
    assert got[0]["lang_pred"] == "und" and got[0]["score"] == 0 and got[1]["lang_pred"] == "und"
    assert {r["lang_pred"] for r in got} <= {"und", "en", "de"}
    one = {r["doc_id"]: r["lang_pred"] for r in
           li.predict(documents([(1, "the the cat"), (2, "und die Katze"), (3, "12 34"), (4, "日本語")]), model).collect()}
    assert one[1] == "en" and one[2] == "de" and one[3] == "und" and one[4] in ("en", "de")
    for nothing in (empty, documents([(1, "text", None, "s", 4)])):
        blank = li.train(nothing, li.held_out())
        assert {(r["lang_pred"], r["score"]) for r in li.predict(edges, blank).collect()} == {("und", 0.0)}
    assert li.predict(empty, model).collect() == []


# --- whitening ----------------------------------------------------------------------

def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0.0) for i, v in rows],
                                 "vec_id long, embedding array<double>, whitened double")


def plain_whitening(rows, k=8):
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    d = x * n - s
    c = d.astype(float) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, [int(v) for v in (d ** 2).sum(axis=1)], c @ u / np.sqrt(e), e / np.trace(c.T @ c / n)


@pytest.mark.parametrize("width,count,flat", [(64, 300, True), (100, 250, False), (12, 60, False), (5, 40, True)])
def test_whitening_matches_eigh(spark, width, count, flat):
    rng = np.random.default_rng(width)
    scale = np.ones(width) if flat else 2.0 ** -np.arange(width).clip(0, 20)
    x = rng.standard_normal((count, width)) * scale * 3
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(0, x[0].tolist())]     # a repeated row
    bad = [(900, None), (901, [float("nan")] * width), (902, [float("inf")] + [0.0] * (width - 1)),
           (903, [None] + [0.0] * (width - 1))]
    got = ew.whitened_rows(vectors(spark, rows + bad).repartition(5)).toPandas()
    n, dev, w, share = plain_whitening(rows)
    assert len(got) == n * min(8, width) and set(got.n) == {n}
    by = got[got.vec_id > 0].pivot(index="vec_id", columns="component", values="whitened")
    want = w[1:-1]
    mine = by.to_numpy()
    sign = np.sign((mine * want).sum(axis=0))
    assert np.abs(mine * sign - want).max() < 1e-8
    one = got[(got.component == 1) & (got.vec_id > 0)].sort_values("vec_id")
    assert one.deviation.tolist() == dev[1:-1]
    assert np.allclose(got.groupby("component").explained.first(), share, rtol=1e-10)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9


def test_subspace_certifies_hard_spectra():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.standard_normal((90, 90)))
    for e in (np.linspace(1.02, 1, 90), np.r_[1e6, 10, np.linspace(1.1, 1, 88)], np.r_[[2.0] * 4, [1.0] * 86]):
        v = (q * e) @ q.T
        found = ew.subspace(lambda b, v=v: v @ b, 90)
        assert np.allclose(found.values, np.sort(e)[::-1][:8], rtol=1e-10)
        assert np.abs(v @ found.vectors - found.vectors * found.values).max() < 1e-9 * e.max()
        assert np.abs(found.vectors.T @ found.vectors - np.eye(8)).max() < 1e-12


def test_whitening_edges(spark):
    assert ew.whitened_rows(vectors(spark, []) ).collect() == []
    assert ew.whitened_rows(vectors(spark, [(1, None), (2, [None, 1.0])])).collect() == []
    assert ew.whitened_rows(vectors(spark, [(1, [1.0, 2.0])] * 5)).collect() == []     # no spread
    two = ew.whitened_rows(vectors(spark, [(1, [1.0, 0.0, 0.0]), (None, [0.0, 0.0, 0.0])])).collect()
    assert [(r["component"], abs(round(r["whitened"], 9))) for r in two] == [(1, 1.0)] * 2
    with pytest.raises(Exception, match="entries"):
        ew.whitened_rows(vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])])).collect()


def test_deviation_beyond_64_bit_products():
    sums = ew.Sums(3, (3 * 2 ** 40, 5))
    x = np.array([[2 ** 40 + 7, 9], [2 ** 40, 1]])
    assert sums.deviations(x).tolist() == [21 ** 2 + 22 ** 2, 2 ** 2]
    big = ew.Sums(2 ** 30, (0, 0))
    with pytest.raises(OverflowError):
        big.deviations(np.array([[2 ** 10, 0]]))


def test_collocations_sql_twin(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    cur = con.execute(co.ORACLE)
    names = [c[0] for c in cur.description]
    want = sorted(cur.fetchall())
    assert want and sorted(tuple(r[c] for c in names) for r in co.query(spark, sf).collect()) == want
