"""Quality by compression: which of two zstandard dictionaries fits a text?

One dictionary is made of texts labelled good, one of texts labelled bad: pieces
of ``PIECE`` bytes drawn by hash from whole texts, in turn from every text.
A text is compressed with each, in chunks of ``CHUNK`` bytes so that a long
text cannot outgrow the dictionaries, and with none. Per byte of text, the
difference of the two sizes (normalised by their sum) and the two rates feed
a logistic curve fitted on labelled rows kept out of the dictionaries: the
calibrated score.

Training rows are bounded (``Limits``): the labelled rows of least hash. Every
text is scored whole.

Defined results: a null or empty text, and every text when the labels have
only one class or too few rows to train on, gets the share of good labels;
equal texts get equal scores; repeated labels of an id count once (the least).
Only doc_id and text of a document are read. A null doc_id is never held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.llm.common import Shared, bucket_of, map_batches, table, texts

CHUNK = 2_048
LEVEL = 3
DICTIONARY_BYTES = 65_536
PIECE = 128                 # bytes of a text that go into a dictionary together
SAMPLE_BYTES = 8_192        # of one text, in pieces from all of it, for a dictionary
THRESHOLD = 0.7


@dataclass(frozen=True)
class Limits:
    """Most labelled rows of each class for the dictionaries and the calibration."""
    dictionary: int = 600
    calibration: int = 1_500


def chunks(data: bytes) -> list[bytes]:
    return [data[i:i + CHUNK] for i in range(0, len(data), CHUNK)]


class Measure:
    """Compressed sizes of a text under the good, the bad and no dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard as z

        def with_dictionary(raw: bytes):
            d = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            return z.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False,
                                    write_dict_id=False)
        self.compressors = [with_dictionary(good), with_dictionary(bad),
                            z.ZstdCompressor(level=LEVEL, write_content_size=False)]

    def __call__(self, text: str) -> np.ndarray:
        data = text.encode("utf-8", "surrogatepass")
        parts = chunks(data)
        good, bad, none = (sum(len(c.compress(p)) for p in parts) for c in self.compressors)
        n = len(data)
        difference = (bad - good) / (bad + good)
        return np.array([difference, np.log(good / n), np.log(bad / n), np.log(none / n),
                         np.log1p(min(n, CHUNK)) / 8, 1.0])


def expand(x: np.ndarray) -> np.ndarray:
    """The measures, their squares and products: the curve may bend."""
    x = np.atleast_2d(x)
    k = x.shape[1]
    return np.column_stack([x[:, i] * x[:, j] for i in range(k) for j in range(i, k)])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights by Newton's method; classes count in their natural shares."""
    t = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ t, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(t))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * t)
        t += step
        if np.abs(step).max() < 1e-8:
            break
    return t


@dataclass
class Model:
    good: bytes
    bad: bytes
    center: np.ndarray
    spread: np.ndarray
    weights: np.ndarray | None      # None: too few labels
    base: float                     # share of good labels

    def scorer(self):
        measure = Measure(self.good, self.bad) if self.weights is not None else None

        def score(text: str) -> float:
            if not text or measure is None:
                return self.base
            x = (expand(measure(text))[0] - self.center) / self.spread
            z = float(np.append(x, 1.0) @ self.weights)
            return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))
        return score


def dictionary_of(samples: list[tuple[bytes, ...]]) -> bytes:
    """Raw dictionary content from each text's pieces in the order drawn: the
    first piece of every text, then the second, until the space is full; what
    was taken first comes last, where zstandard finds it cheapest."""
    taken, size = [], 0
    for turn in range(max(map(len, samples), default=0)):
        for s in samples:
            if turn < len(s) and size < DICTIONARY_BYTES:
                taken.append(s[turn])
                size += len(s[turn])
    return b"".join(reversed(taken))[-DICTIONARY_BYTES:] or b" "


def pieces(text: str) -> list[bytes]:
    """At most ``SAMPLE_BYTES`` of a text in pieces drawn by hash from all of it."""
    from xxhash import xxh3_64_intdigest
    data = text.encode("utf-8", "surrogatepass")
    seed = xxh3_64_intdigest(data)
    cut = [data[i:i + PIECE] for i in range(0, len(data), PIECE)]
    drawn = sorted(range(len(cut)), key=lambda i: xxh3_64_intdigest(i.to_bytes(8, "little"), seed))
    return [cut[i] for i in drawn[:SAMPLE_BYTES // PIECE]]


def train(docs: DataFrame, labels: DataFrame, held_out: Column, doc_id: str = "doc_id",
          text: str = "text", label: str = "quality", limits: Limits = Limits()) -> Model:
    """``held_out``: a condition on doc_id; no label of such a row is used."""
    known = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out)
             .groupBy(F.col(doc_id).alias("__id")).agg(F.min(label).alias("__y")))
    h = F.xxhash64(F.col("__id").cast("string"), F.lit("quality"))
    known = known.withColumn("__h", h).withColumn("__fold", F.pmod(F.shiftright("__h", 8), F.lit(2)))
    n = known.agg(F.count(F.lit(1)).alias("n"), F.sum("__y").alias("k")).first()
    base = float(n["k"]) / n["n"] if n["n"] else 0.5
    picked = None
    for y in (1, 0):
        for fold, most in ((0, limits.dictionary), (1, limits.calibration)):
            one = (known.where((F.col("__y") == y) & (F.col("__fold") == fold))
                   .orderBy("__h", "__id").limit(most).select("__id", "__y", "__fold", "__h"))
            picked = one if picked is None else picked.unionByName(one)
    sample = (docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
              .join(F.broadcast(picked), "__id").where(F.length("__text") > 0))

    # dictionary pieces come to the driver (bounded); calibration texts stay
    def make():
        def run(batch: pa.RecordBatch) -> dict:
            return {"y": batch.column(0), "h": batch.column(1),
                    "pieces": [pieces(t) for t in texts(batch.column(2))]}
        return run
    rows = map_batches(sample.where("__fold = 0").select("__y", "__h", "__text"), make,
                       f"y {known.schema['__y'].dataType.simpleString()}, h long, pieces array<binary>"
                       ).toArrow().to_pylist()
    rows.sort(key=lambda r: (r["h"], r["pieces"]))
    good, bad = (list(dict.fromkeys(tuple(r["pieces"]) for r in rows if r["y"] == y)) for y in (1, 0))
    empty = Model(b" ", b" ", np.zeros(1), np.ones(1), None, base)
    if not good or not bad:
        return empty
    model = Model(dictionary_of(good), dictionary_of(bad), np.zeros(1), np.ones(1), None, base)
    shared = Shared(docs.sparkSession, model)

    def make_measures():
        m = shared.load()
        measure = Measure(m.good, m.bad)

        def run(batch: pa.RecordBatch) -> dict:
            return {"y": batch.column(0), "h": batch.column(1),
                    "x": [measure(t) for t in texts(batch.column(2))]}
        return run
    rows = map_batches(sample.where("__fold = 1").select("__y", "__h", "__text"), make_measures,
                       f"y {known.schema['__y'].dataType.simpleString()}, h long, x array<double>"
                       ).toArrow().to_pylist()
    rows.sort(key=lambda r: (r["h"], r["x"]))
    y = np.array([float(r["y"]) for r in rows])
    if len(set(y.tolist())) < 2:
        return empty
    x = expand(np.array([r["x"] for r in rows]))
    model.center, model.spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack(((x - model.center) / model.spread, np.ones(len(x))))
    model.weights = fit_logistic(z, y)
    # the classes were sampled apart: move the odds back to their true shares
    drawn = y.mean()
    model.weights[-1] += np.log(base / (1 - base)) - np.log(drawn / (1 - drawn))
    return model


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score per document row."""
    shared = Shared(docs.sparkSession, model)
    kind = docs.schema[doc_id].dataType.simpleString()

    def make():
        one = shared.load().scorer()

        def run(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column(0), "score": [one(t) for t in texts(batch.column(1))]}
        return run
    return map_batches(docs.select(doc_id, text), make, f"doc_id {kind}, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    return (bucket_of(F.col(doc_id), 4) == 2) & F.col(doc_id).isNotNull()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), held_out())
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
