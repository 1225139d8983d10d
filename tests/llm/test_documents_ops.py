"""Operators on documents against brute force, with the odd cases."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clusterlens.llm import (bpe, compression_quality, decontaminate, near_dedup, quality_rules,
                             resharding, token_files, toxicity)
from clusterlens.session import scratch_path
from llm_fixtures import documents, edges, empty  # noqa: F401


def rows_of(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.TOKENIZER)


# --- quality rules -------------------------------------------------------

def brute_rules(text):
    import re
    text = text or ""
    words = [w for w in re.split(r"[ \t-\r]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^ \t-\r]", x)]
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(wins)
    hit = {i + k for i, w in enumerate(wins) if n[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(hit))


def test_quality_metrics_equal_brute_force(spark, documents, edges):
    rng = random.Random(1)
    texts = ["".join(rng.choices(["a", "b", "c ", " ", "\n", "#", "é", "\x0b", "🙂"], k=rng.randint(0, 60)))
             for _ in range(300)] + ["x y z " * 40, "same line\n" * 5]
    docs = documents(list(enumerate(texts, 100))).unionByName(edges)
    out = quality_rules.judge(docs, keep=("doc_id", "text"))
    got = rows_of(out, "text", *["qr_" + m for m in quality_rules.METRICS])
    assert len(got) == docs.count()
    for text, *metrics in got:
        assert tuple(metrics) == brute_rules(text), repr(text)


def test_windows_of_equal_hash_are_told_apart_by_their_words(spark, documents, monkeypatch):
    # a hash with three values: nearly all windows clash
    real = F.xxhash64
    monkeypatch.setattr(quality_rules.F, "xxhash64", lambda *c: F.pmod(real(*c), F.lit(3)))
    rng = random.Random(2)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 40))) for _ in range(150)]
    texts += ["x y z " * 20, " ".join(f"w{i}" for i in range(400)), "a b c d a b c"]
    out = quality_rules.with_metrics(documents(list(enumerate(texts))))
    for text, hit in rows_of(out, "text", "n_repeat_words"):
        assert hit == brute_rules(text)[4], text


def test_bad_host_takes_its_documents_along(spark, documents):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "bad", "en", "junk", 3) for i in range(60)] + [(100, good, "en", "junk", 1)]
    rows += [(200 + i, good + str(i), "en", f"h{i % 5}", 1) for i in range(60)] + [(300, good, "en", None, 1)]
    got = dict(rows_of(quality_rules.judge(documents(rows)), "doc_id", "qr_kept"))
    assert not got[100] and got[300] and all(got[200 + i] for i in range(60))


def test_quality_filter_keeps_clashing_columns(spark, documents, empty):
    docs = documents([(1, " ".join(f"w{i}" for i in range(60)), "en", "s", 1)]).withColumns(
        {"n_words": F.lit(7), "kept": F.lit("x"), "host": F.lit(1)})
    out = quality_rules.filter_documents(docs)
    assert out.columns == docs.columns and out.first()["n_words"] == 7
    assert quality_rules.filter_documents(empty).count() == 0


# --- BPE and token files ---------------------------------------------------

def test_bpe_equals_the_library_on_random_strings():
    enc, lib = bpe.Encoder(bpe.Vocabulary(bpe.TOKENIZER)), library()
    rng = random.Random(5)
    parts = ["a", "the", "ing", " ", "  ", "   ", "\n", "\t", "é", "ß", "日本", "🙂", "'s", "12", "!",
             "<|endoftext|>", "\x1c", "\x85", "　", "²", "_", "\r\n", "----", "aaaa", "Zx"]
    for _ in range(4000):
        s = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        ids = enc.encode(s)
        assert ids.tolist() == lib.encode(s, add_special_tokens=False).ids, repr(s)
        assert enc.vocab.decode(ids) == s


def test_full_caches_are_emptied(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 5)
    enc, lib = bpe.Encoder(bpe.Vocabulary(bpe.TOKENIZER)), library()
    for i in range(30):
        text = f"some new words number{i} and more, {i}!"
        assert enc.encode(text).tolist() == lib.encode(text, add_special_tokens=False).ids
    assert len(enc.pieces) < 30


@pytest.mark.parametrize("make", [lambda: bpe.Encoder(bpe.Vocabulary(bpe.TOKENIZER)),
                                  lambda: token_files.LibraryEncoder(bpe.TOKENIZER)])
def test_caches_are_bounded_on_indented_and_unspaced_texts(monkeypatch, make):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 20_000)
    enc, lib = make(), library()
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    for i in range(300):
        word = "".join(rng.choices(letters, k=9))
        for text in (f"def {word}():\n    return {word}{i}\n", "".join(rng.choices(letters, k=700)),
                     f"{word} {i} {word[::-1]}, {word[3:]}."):
            assert enc.encode(text).tolist() == lib.encode(text, add_special_tokens=False).ids
        for cache in (enc.pieces, enc.spaced):
            assert cache.held == sum(bpe._ENTRY + 4 * len(k) + len(v) for k, v in cache.items()) <= 20_000
            assert all(len(k) < bpe.LONG_PIECE for k in cache)


def test_bpe_digest_and_round_trip(spark, edges, empty):
    lib = library()
    got = rows_of(bpe.digest(edges.withColumn("ids", F.lit(1))), "doc_id", "n_tokens", "ids_sha256",
                  "decoded_sha256")
    want = []
    for r in edges.collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    key = lambda t: (t[0] is None, t[0] or 0, t[1:])
    assert sorted(got, key=key) == sorted(want, key=key)
    back = bpe.decode(bpe.encode(edges))
    assert Counter(rows_of(back, "doc_id", "text")) == Counter(
        (r.doc_id, r.text or "") for r in edges.collect())
    assert bpe.digest(empty).count() == 0


@pytest.mark.parametrize("width", [1, 5, 8, 13, 16, 17, 24, 31, 32])
def test_packing_round_trip_and_random_access(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 777).astype(np.uint32)
    packed = token_files.pack(ids, width)
    assert len(packed) == (777 * width + 7) // 8
    assert (token_files.unpack(packed, width, 0, 777) == ids).all()
    assert (token_files.unpack(b"abc" + packed, width, 100, 50, 3) == ids[100:150]).all()
    docs = [ids[:10], ids[10:10], ids[10:500]]
    block = token_files.Block(token_files.make_block(docs, width))
    assert len(block) == 3 and all((block.document(k) == d).all() for k, d in enumerate(docs))
    with pytest.raises(IndexError):
        block.ids(400, 200)


def test_token_files_hold_all_documents_in_order(spark, edges, empty):
    path = scratch_path(spark, "tokens")
    token_files.write(edges, path, block_ids=100)
    got = sorted(rows_of(token_files.documents(token_files.read(spark, path)), "start", "doc_id",
                         "n_tokens", "ids_crc32"))
    lib, at = library(), 0
    rows = sorted(edges.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    for r, (start, doc_id, n, crc) in zip(rows, got, strict=True):
        ids = lib.encode(r.text or "", add_special_tokens=False).ids + [0]
        assert (start, doc_id, n) == (at, r.doc_id, len(ids))
        assert crc == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += n
    path = scratch_path(spark, "tokens")
    token_files.write(empty, path)
    assert token_files.documents(token_files.read(spark, path)).count() == 0


# --- decontamination -------------------------------------------------------

def brute_hits(words, items):
    hit, found = set(), set()
    for name, w in items:
        wins = [w[i:i + 10] for i in range(max(len(w) - 9, 1))] if w else []
        for win in wins:
            for i in range(len(words) - len(win) + 1):
                if words[i:i + len(win)] == win:
                    hit.update(range(i, i + len(win)))
                    found.add(name)
    return hit, found


def test_decontaminate_equals_brute_force(spark, documents, edges, empty):
    rng = random.Random(2)
    word = lambda: rng.choice("abcd")
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 4, 9, 10, 11, 14, 30])))) for i in range(3, 40)]
    items += [(1, None), (2, "!!"), (3, items[0][1]), (None, "no id item with words")]
    texts = [" ".join(word() if rng.random() < .97 else "X." for _ in range(rng.randint(0, 60)))
             for _ in range(60)] + [items[7][1].upper() + " zz"]
    docs = documents(list(enumerate(texts, 50))).unionByName(edges)
    bench = spark.createDataFrame(items, "item_id long, text string")
    coded = [(str(i) if i is not None else "", decontaminate.words_of(t or "")) for i, t in items]
    want = []
    for r in docs.collect():
        w = decontaminate.words_of(r.text or "")
        hit, found = brute_hits(w, coded) if len(w) < 1000 else (set(), set())
        want.append((r.doc_id, len(w), len(hit), sorted(found)))
    for limit in (100_000, 200):            # one automaton, then several
        got = [(r.doc_id, r.n_words, sum(r.marks or b""), list(r["items"]))
               for r in decontaminate.find(docs, bench, max_words=limit).collect()]
        key = lambda t: (t[0] is None, t[0] or 0, t[1:])
        assert sorted(got, key=key) == sorted(want, key=key)
    assert decontaminate.find(empty, bench).count() == 0
    assert decontaminate.find(docs, bench.limit(0)).where("marks is not null").count() == 0


def test_cut_removes_passages_and_leaves_the_rest(spark, documents):
    item = " ".join(f"q{i}" for i in range(12))
    clean = " ".join(f"w{i}" for i in range(50))
    docs = documents([(1, clean), (2, f"{clean} {item}, {clean}"), (3, item), (4, None)])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.clean_documents(docs, bench).collect()}
    assert set(got) == {1, 2, 4} and got[1].text == clean and got[4].text is None
    assert "q5" not in got[2].text and got[2].text.count("w49") == 2
    assert got[2].n_chars == len(got[2].text)


# --- near duplicates -------------------------------------------------------

def edit_distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (x != y))
    return d[-1]


def test_banded_alignment_equals_the_plain_one():
    rng = random.Random(3)
    for _ in range(1500):
        a = [rng.randint(0, 3) for _ in range(rng.randint(0, 40))]
        b = list(a) if rng.random() < .7 else [rng.randint(0, 3) for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 8)):
            if b and rng.random() < .5:
                b.pop(rng.randrange(len(b)))
            else:
                b.insert(rng.randint(0, len(b)), rng.randint(0, 5))
        limit, e = rng.randint(0, 20), edit_distance(a, b)
        assert near_dedup.edits_within(a, b, limit) == (e if e <= limit else None)


def test_sketch_depends_on_order():
    s = near_dedup.Sketcher()
    w = [str(i).encode() for i in range(200)]
    same = (s(w) == s(w)).sum()
    swapped = (s(w) == s(w[100:] + w[:100])).sum()
    assert same == near_dedup.FUNCTIONS and swapped < same * 0.75


def test_classes_equal_brute_force_with_hot_groups(spark, documents):
    rng = random.Random(4)
    word = lambda: f"v{rng.randint(0, 4000)}"
    passage = [word() for _ in range(55)]
    texts = []
    hot = [word() for _ in range(120)]
    for _ in range(60):                              # near copies of one text
        t = list(hot)
        for _ in range(3):
            t[rng.randrange(len(t))] = word()
        texts.append(t)
    texts += [hot] * 40                              # exact copies
    texts += [passage + [word() for _ in range(70)] for _ in range(120)]   # a shared passage
    texts += [[word() for _ in range(80)] for _ in range(60)]
    rng.shuffle(texts)
    docs = documents([(i, " ".join(t)) for i, t in enumerate(texts)])
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(texts)):
        for j in range(i):
            a, b = texts[i], texts[j]
            if root(i) != root(j) and near_dedup.similar(a, b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    got = dict(rows_of(near_dedup.classes(docs), "doc_id", "class_id"))
    assert got == {i: root(i) for i in range(len(texts))}


@pytest.mark.parametrize("tile", [1024, 50])
def test_pairs_of_a_large_bucket_are_all_compared(spark, documents, monkeypatch, tile):
    # texts that share only a passage, and a copy of each whose own part keeps
    # no run of 5 words: such a pair meets in the passage's buckets alone
    monkeypatch.setattr(near_dedup, "TILE", tile, raising=False)
    rng = random.Random(8)
    word = lambda: f"v{rng.randint(0, 40_000)}"
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(60):
        own = [word() for _ in range(64)]
        copy = [word() if i % 4 == 3 else w for i, w in enumerate(own)]
        texts += [passage + own, passage + copy]
    sketch = near_dedup.Sketcher()
    keys = [sketch([w.encode() for w in t]) for t in texts]
    met = [i for i in range(0, len(texts), 2) if (keys[i] == keys[i + 1]).any()]
    large = max(Counter(int(k) for row in keys for k in row).values())
    assert len(met) > 50 and large > 2 * near_dedup.PAIRWISE
    assert all(near_dedup.similar(texts[i], texts[i + 1]) for i in met)
    got = dict(rows_of(near_dedup.classes(documents([(i, " ".join(t)) for i, t in enumerate(texts)])),
                       "doc_id", "class_id"))
    linked = {i for i in range(0, len(texts), 2) if got[i + 1] == i}
    assert linked == set(met) and all(got[i] == i for i in range(0, len(texts), 2))


def test_open_pairs_of_a_large_bucket_make_no_row_each(spark, documents, monkeypatch):
    # one passage, then the same words in another order: counters leave every pair
    # open, and alignment parts all but the near copies
    rng = random.Random(12)
    passage, pool = [f"p{i}" for i in range(100)], [f"q{i}" for i in range(45)]
    texts = [passage + rng.sample(pool, 40) for _ in range(80)]
    for t in texts[::4]:
        texts.append([*t[:102], "changed", *t[103:]])
    aligned, judge = [], near_dedup._judged

    def counted(pairs, *rest, **options):
        aligned.append(pairs.count())
        return judge(pairs, *rest, **options)
    monkeypatch.setattr(near_dedup, "_judged", counted)
    monkeypatch.setattr(near_dedup, "PAIRS", 300, raising=False)
    monkeypatch.setattr(near_dedup, "PAIRWISE", 1)          # every bucket counts as large
    got = dict(rows_of(near_dedup.classes(documents([(i, " ".join(t)) for i, t in enumerate(texts)])),
                       "doc_id", "class_id"))
    parent = list(range(len(texts)))

    def root(x):
        return x if parent[x] == x else root(parent[x])
    linked = 0
    for i, a in enumerate(texts):
        for j in range(i):
            if near_dedup.similar(a, texts[j]):
                linked += 1
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    assert 20 <= linked < 1000 and got == {i: root(i) for i in range(len(texts))}
    assert aligned[-1] < len(texts)


def test_texts_of_one_doc_id_keep_their_own_links(spark, documents):
    # doc 1 has two texts of equally many words; 2 is near the one, 3 near the other
    rng = random.Random(9)
    rows, groups = [], 12
    for g in range(groups):
        text = lambda: [f"w{rng.randrange(10**6)}" for _ in range(60)]
        a, b = text(), text()
        near = [[*t[:30], "changed", *t[31:]] for t in (a, b)]
        rows += [(10 * g + i, " ".join(t)) for i, t in ((1, a), (1, b), (2, near[0]), (3, near[1]), (4, text()))]
    got = near_dedup.classes(documents(rows)).collect()
    by = {}
    for r in got:
        by.setdefault(r.class_id, set()).add(r.doc_id)
    want = [{10 * g + i for i in (1, 2, 3)} for g in range(groups)] + [{10 * g + 4} for g in range(groups)]
    assert sorted(map(sorted, by.values())) == sorted(map(sorted, want))
    assert all(min(ids) == c for c, ids in by.items())


def test_near_dedup_odd_cases(spark, documents, edges, empty):
    got = Counter(rows_of(near_dedup.classes(edges), "doc_id", "class_id"))
    assert got == Counter({(1, 1): 1, (2, 1): 1, (3, 3): 2, (4, 4): 1, (5, 5): 1, (6, 6): 1,
                           (None, None): 1})
    kept = near_dedup.keep_one(edges.withColumn("class_id", F.lit("x")))
    assert sorted(rows_of(kept, "doc_id"), key=str) == sorted(
        [(1,), (3,), (4,), (5,), (6,), (None,)], key=str)
    assert near_dedup.classes(empty).count() == 0 and near_dedup.keep_one(empty).count() == 0
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    versions = documents([(7, a), (7, b), (8, a), (9, b)])      # one id, two texts
    assert set(rows_of(near_dedup.classes(versions), "doc_id", "class_id")) == {(7, 7), (8, 7), (9, 7)}


# --- resharding --------------------------------------------------------------

def test_flow_moves_the_fewest_bytes():
    rng = random.Random(6)
    for _ in range(50):
        n = rng.randint(2, 6)
        supply = [rng.randint(0, 40) for _ in range(n)]
        total = sum(supply)
        capacity = [total // n + (k < total % n) for k in range(n)]
        flow = resharding.transfers(supply, capacity)
        assert [sum(f for (a, _), f in flow.items() if a == i) for i in range(n)] == supply
        moved = sum(f for (a, b), f in flow.items() if a != b)
        assert moved == sum(max(0, s - c) for s, c in zip(supply, capacity))


def test_reshard_levels_keeps_groups_and_numbers_slots(spark, documents, edges, empty):
    rng = random.Random(7)
    texts = ["hot text " * 30] * 200 + ["x" * rng.randint(0, 400) for _ in range(600)]
    docs = documents(list(enumerate(texts, 1000))).unionByName(edges.where("length(text) < 99 or text is null"))
    placed, affected = resharding.reshard(docs, shards=8)
    path = scratch_path(spark, "shards")
    resharding.rewrite(placed, path)
    got = resharding.read(spark, path).select("doc_id", "text", "shard", "slot").toPandas()
    assert len(got) == docs.count()
    for _, g in got.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    assert got.assign(text=got.text.fillna("")).groupby("text").shard.nunique().max() == 1
    size = got.text.fillna("").str.encode("utf-8").str.len() + 16
    sums = size.groupby(got.shard).sum().sort_values()
    hot = got[got.text == texts[0]].shard.iloc[0]
    rest = sums.drop(hot)
    assert rest.max() - rest.min() <= 800 and sums[hot] >= 200 * (len(texts[0]) + 16)
    moved = placed.where("shard <> old_shard").select("old_shard", "shard").distinct().collect()
    assert {s for r in moved for s in r} <= affected
    placed, affected = resharding.reshard(empty)
    assert placed.count() == 0 and not affected


# --- classifiers -------------------------------------------------------------

def labelled(spark, sf_dir="/root/testdata/sf0.01"):
    return (spark.read.parquet(f"{sf_dir}/documents.parquet"),
            spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas().set_index("doc_id"))


def test_quality_is_accurate_on_held_out_rows(spark):
    _, labels = labelled(spark)
    got = compression_quality.query(spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    assert len(got) == 1000 and got.score.between(0, 1).all()
    test = got[got.held_out].join(labels, how="inner")
    assert (test.predicted == test.quality).mean() > 0.9


def test_quality_is_learned_from_whole_texts(spark, documents):
    # only what follows an opening of 300 characters tells the classes apart,
    # and more texts a class are labelled than a dictionary takes
    rng = random.Random(9)
    some = lambda n: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(n)]
    opening, tails = some(300), {1: some(300), 0: some(300)}
    rows = [(i, " ".join(rng.choices(opening, k=38) + rng.choices(tails[i % 2], k=60))) for i in range(3_000)]
    docs = documents(rows)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    model = compression_quality.train(docs, labels, F.col("doc_id") >= 2_600)
    found = [model.good.count(w.encode()) > 0 for w in tails[1]]
    assert np.mean(found) > 0.99 and len(model.good) == compression_quality.DICTIONARY_BYTES
    got = rows_of(compression_quality.score(docs.where("doc_id >= 2600"), model), "doc_id", "score")
    assert np.mean([(s >= 0.5) == i % 2 for i, s in got]) > 0.99


def test_toxicity_leaves_clean_documents_alone(spark):
    _, labels = labelled(spark)
    got = toxicity.query(spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    test = got[got.held_out].join(labels, how="inner")
    assert test[test.toxic == 0].predicted.mean() < 0.02
    assert test[test.toxic == 1].score.mean() > test[test.toxic == 0].score.mean() + 0.2


def test_toxicity_scores_do_not_depend_on_the_drawn_shares(spark):
    docs, labels = labelled(spark, "/root/testdata/sf0.1")
    table = spark.createDataFrame(labels.reset_index())
    some = docs.join(table.select("doc_id"), "doc_id", "left_semi").select("doc_id", "text").persist()
    share, mean = {}, {}
    for most in (3_000, 60):            # natural shares of about 1 to 8, then 1 to 1
        model = toxicity.train(docs, table, toxicity.held_out(),
                               limits=toxicity.Limits(calibration=most))
        got = toxicity.score(some, model).agg(
            F.avg((F.col("score") >= toxicity.THRESHOLD).cast("double")), F.avg("score")).first()
        share[most], mean[most] = got
    some.unpersist()
    assert abs(share[60] - share[3_000]) < 0.02 and abs(mean[60] - mean[3_000]) < 0.03


def test_toxicity_limits_and_held_out_recall(spark):
    assert toxicity.Limits() == toxicity.Limits(positives=3_000, unlabelled=9_000, calibration=3_000)
    _, labels = labelled(spark, "/root/testdata/sf0.1")
    got = toxicity.query(spark, "/root/testdata/sf0.1").toPandas().set_index("doc_id")
    test = got[got.held_out].join(labels, how="inner")
    hit = test[test.predicted == 1]
    recall, precision = (test[test.toxic == 1].predicted.mean(), hit.toxic.mean())
    print("held-out recall, precision", recall, precision, len(test), test.toxic.sum())
    assert precision > 0.93 and recall > 0.8


def test_non_negative_risk_finds_the_marking_feature(spark):
    rng = np.random.default_rng(0)
    row = lambda bad: np.append(rng.integers(100, 400, 20), [7] if bad else []).astype(np.int64)
    pos = [row(True) for _ in range(100)]
    unlabelled = [row(rng.random() < .1) for _ in range(400)]
    rows = spark.createDataFrame([("P", r.tolist()) for r in pos] + [("U", r.tolist()) for r in unlabelled],
                                 "kind string, features array<int>")
    counts = toxicity.document_counts(rows.repartition(4))

    def shares(rs):
        return np.bincount(np.concatenate([np.unique(r) for r in rs]), minlength=400)
    for kind, rs in (("P", pos), ("U", unlabelled)):
        assert counts[kind][0] == len(rs) and counts[kind][1][:400].tolist() == shares(rs).tolist()
    use = np.flatnonzero(toxicity.select_features(counts["P"], counts["U"]))
    assert 7 in use and len(use) <= 2
    w, b = toxicity.fit_nnpu(*[[r[np.isin(r, use)] for r in rs] for rs in (pos, unlabelled)], 0.1)
    assert b < 0 < b + w[7]


@pytest.mark.parametrize("shift", [3.0, -6.0])      # corrected part above and below zero
def test_risk_and_its_slope_equal_plain_sums(shift):
    from math import exp, log
    rng = np.random.default_rng(2)
    pos, prior = np.arange(50) < 20, 0.4
    z = rng.normal(size=50) + np.where(pos, 3.0, shift)
    own, corrected = toxicity.risk(z, pos, prior)
    clean = lambda m: log(1 + exp(m))
    assert own == pytest.approx(prior * sum(clean(-m) for m in z[:20]) / 20)
    assert corrected == pytest.approx(sum(map(clean, z[20:])) / 30 - prior * sum(map(clean, z[:20])) / 20)
    assert (corrected >= 0) == (shift > 0)

    def target(z):
        own, corrected = toxicity.risk(z, pos, prior)
        return own + corrected if shift > 0 else -corrected
    step = 1e-6 * np.eye(50)
    numeric = [(target(z + e) - target(z - e)) / 2e-6 for e in step]
    np.testing.assert_allclose(toxicity.slope(z, pos, prior), numeric, atol=1e-7)


def test_scores_equal_plain_sums_of_word_weights(spark, documents):
    from math import exp
    rng = np.random.default_rng(3)
    weights = np.where(rng.random(toxicity.BUCKETS) < 0.3, rng.normal(size=toxicity.BUCKETS), 0)
    model = toxicity.Model(weights, -0.5, 0.05, 0.2)
    words = [f"w{i}" for i in range(200)]
    documents = documents([(i, " ".join(rng.choice(words, 5 * i))) for i in range(40)] + [(40, None)])
    rows = documents.select("doc_id", "text").orderBy("doc_id").limit(60).collect()
    want = {}
    for r in rows:
        margin = -0.5 + sum(weights[f] for w in toxicity.distinct_words(r.text or "")
                            for f in toxicity.features_of(w))
        want[r.doc_id] = 1 / (1 + exp(-(0.05 * margin + 0.2)))
    got = toxicity.score(spark.createDataFrame(rows, documents.select("doc_id", "text").schema), model).collect()
    assert len(got) == len(rows) and all(r.score == pytest.approx(want[r.doc_id]) for r in got)


def test_one_training_row_per_copy_group(spark):
    rng = np.random.default_rng(1)
    rows = [("P", sorted(rng.choice(5_000, 30, replace=False).tolist())) for _ in range(60)]
    copies = [("P", rows[0][1])] * 40 + [("P", rows[1][1] + [4_999_999 % 6_000])] * 3
    other = [("U", r) for _, r in rows[:5]] + [("U", [])]
    df = spark.createDataFrame(rows + copies + other, "kind string, features array<int>").repartition(5)
    got = [(r.kind, tuple(r.features)) for r in toxicity.one_per_copy_group(df).collect()]
    assert sorted(got) == sorted({(k, tuple(f)) for k, f in rows + other})


@pytest.mark.parametrize("op", [toxicity, compression_quality])
def test_classifiers_odd_cases(spark, edges, empty, op):
    label = "toxic" if op is toxicity else "quality"
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    few = spark.createDataFrame([(3, 1), (3, 1), (4, 0), (None, 1), (6, None), (99, 1)],
                                f"doc_id long, {label} int")
    for labels in (none, few):
        model = op.train(edges, labels, F.lit(False))
        out = op.score(edges.select("doc_id", "text"), model).collect()
        assert len(out) == 8 and all(0 <= r.score <= 1 for r in out)
        same = [r.score for r in out if r.doc_id == 3]
        assert same[0] == same[1]
        assert op.score(empty.select("doc_id", "text"), model).count() == 0
