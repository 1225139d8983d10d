"""P2 and P4 on a stream: indices stay, replays change nothing, vectors widen."""

import pytest
from pyspark.sql import functions as F

from clusterlens.operators import encode
from clusterlens.schema import RecordLayout
from clusterlens.session import scratch_path
from clusterlens.streaming.dictionary import StreamDictionary, widen

LAYOUT = RecordLayout(width=5, categorical=(0, 2), names=("a", "x", "b", "y", "label"))
BATCHES = [["m,1,q,2,L.", "k,1,q,2,L."], ["z,3,p,4,L.", "k,3,q,4,L.", "bad,9"], [], ["a,5,r,6,L.", "m,5,p,6,L."]]


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "line string")


def entries(d, before=None):
    return {(r.field, r.value): r.idx for r in d.dictionary(before).collect()}


def brute(batches):
    out = {}
    for rows in batches:
        fields = [r.split(",") for r in rows]
        for f in LAYOUT.categorical:
            for v in sorted({r[f] for r in fields if len(r) > f} - {v for g, v in out if g == f}):
                out[f, v] = sum(g == f for g, _ in out)
    return out


@pytest.mark.parametrize("every", [1, 2, 16])
def test_indices_stay_over_replay_and_restart(spark, every):
    root = scratch_path(spark, "d")
    for i, rows in enumerate(BATCHES):
        d = StreamDictionary(spark, root, LAYOUT, every=every)          # a restart each time
        d.process(lines(spark, rows), i)
        assert entries(d) == brute(BATCHES[:i + 1])
    for i in (3, 1):                                                    # also of batches that compact
        d.process(lines(spark, BATCHES[i]), i)
        assert entries(d) == brute(BATCHES) and entries(d, 2) == brute(BATCHES[:2])


def test_old_vectors_widen_to_the_last_dictionary(spark):
    d = StreamDictionary(spark, scratch_path(spark, "d"), LAYOUT)
    for i, rows in enumerate(BATCHES):
        d.process(lines(spark, rows), i)
    for i, rows in enumerate(BATCHES):
        old = d.encode(lines(spark, rows), i + 1, keep=("line",))
        got = old.select("line", widen("features", LAYOUT, d.sizes(i + 1), d.sizes()).alias("f"), "unseen")
        want = d.encode(lines(spark, rows), keep=("line",)).select("line", "features", F.lit(False))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_widen_refuses_other_widths(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "features array<double>")
    with pytest.raises(Exception, match="wide"):
        df.select(widen("features", LAYOUT, {0: 1, 2: 1}, {0: 2, 2: 1})).collect()
    with pytest.raises(ValueError, match="fewer"):
        widen("features", LAYOUT, {0: 2}, {0: 1})


def test_too_many_values_stop_before_the_batch_is_entered(spark, monkeypatch):
    monkeypatch.setattr(encode, "MAX_CATEGORIES", 2)
    d = StreamDictionary(spark, scratch_path(spark, "d"), LAYOUT)
    d.process(lines(spark, BATCHES[0]), 0)
    with pytest.raises(ValueError, match="too many"):
        d.process(lines(spark, BATCHES[1]), 1)
    assert d.log.versions() == [0]
