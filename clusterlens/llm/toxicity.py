"""Toxicity by non-negative positive-unlabelled learning.

A linear model over hashed word features (each distinct word as a whole and
its first four and five letters) is trained from confirmed toxic texts and
unlabelled ones, on features more frequent in the former than chance allows.
Unlabelled rows are drawn from all documents whether labelled or not, toxic ones
too, without a look at labels, so that they are one population with the prior's
share of toxic rows.
The risk is the class-prior-corrected estimate

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

whose second part must not fall below zero; where it does, the step goes the
other way. The prior is the share of toxic rows among the labelled rows used
for training. Scores are calibrated on labelled rows kept out of the fit, with
the odds moved from the drawn shares to those of all labelled rows.

Training rows are bounded (``Limits``): the rows of least hash of each kind.
Their texts and features stay on the executors, which count and choose features;
the driver gets the chosen feature numbers of each row.
Scoring covers every text as a whole.

Defined results: a null or empty text has no features and gets the base
score; repeated rows get equal scores; without labelled toxic rows every score
is 0; ids without a text or label do not matter. Only doc_id and text of a
document are read. A null doc_id is never held out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.llm.common import Shared, bucket_of, hand_back, map_batches, staged, table, texts

BUCKETS = 1 << 18
THRESHOLD = 0.7
MAX_WORD_CACHE = 400_000
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Limits:
    """Most rows used for training."""
    positives: int = 3_000
    unlabelled: int = 9_000
    calibration: int = 3_000


def features_of(word: str) -> list[int]:
    from zlib import crc32
    return [crc32(f.encode()) % BUCKETS for f in ("w" + word, "4" + word[:4], "5" + word[:5])]


def distinct_words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


@dataclass
class Model:
    weights: np.ndarray         # per bucket
    bias: float
    scale: float                # calibration: sigmoid(scale * margin + shift)
    shift: float
    empty: bool = False

    def score(self, margin: float) -> float:
        if self.empty:
            return 0.0
        z = self.scale * margin + self.shift
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -50, 50))))

    def scorer(self):
        """Function text -> score, with a cache of word weights."""
        known: dict[str, float] = {}
        weights = {int(i): float(self.weights[i]) for i in np.flatnonzero(self.weights)}

        def weight(word: str) -> float:
            if len(known) >= MAX_WORD_CACHE:
                known.clear()
            w = known[word] = sum(weights.get(f, 0.0) for f in features_of(word))
            return w

        def score(text: str) -> float:
            get = known.get
            # sorted: the sum must not depend on the set's order
            parts = [w for w in [get(x) if x in known else weight(x)
                                 for x in distinct_words(text)] if w]
            return self.score(self.bias + sum(sorted(parts)))
        return score


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def document_counts(rows: DataFrame) -> dict[str, tuple[int, np.ndarray]]:
    """By kind the number of rows and of rows with each feature: an array of
    ``BUCKETS`` numbers a task, added up per kind, two of them to the driver."""
    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for kind, features in zip(batch.column(0).to_pylist(), batch.column(1)):
                mine = total.setdefault(kind, np.zeros(BUCKETS + 1, np.int64))
                mine[np.unique(features.values.to_numpy())] += 1
                mine[BUCKETS] += 1
        for kind, mine in total.items():
            yield pa.RecordBatch.from_pydict({"kind": [kind], "counts": [mine.tobytes()]})

    def merge(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for kind, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(counts, np.int64)
                total[kind] = total[kind] + counts if kind in total else counts
        for kind, mine in total.items():
            yield pa.RecordBatch.from_pydict({"kind": [kind], "counts": [mine.tobytes()]})
    schema = "kind string, counts binary"
    got = (rows.select("kind", "features").mapInArrow(count, schema).repartition("kind")
           .mapInArrow(merge, schema).toArrow())
    out = {}
    for kind, counts in zip(got["kind"].to_pylist(), got["counts"].to_pylist()):
        counts = np.frombuffer(counts, np.int64)
        out[kind] = (int(counts[BUCKETS]), counts[:BUCKETS])
    return out


def _narrowed(rows: DataFrame, masks: dict[str, np.ndarray]) -> DataFrame:
    """kind, features and those of them that the kind's mask has, in ``chosen``."""
    packed = {kind: np.packbits(mask).tobytes() for kind, mask in masks.items()}    # 32 KB each

    def make():
        keep = {kind: np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool) for kind, bits in packed.items()}

        def run(batch: pa.RecordBatch) -> dict:
            chosen = []
            for kind, features in zip(batch.column(0).to_pylist(), batch.column(1)):
                f = features.values.to_numpy()
                chosen.append(f[keep[kind][f]])
            return {"kind": batch.column(0), "features": batch.column(1), "chosen": chosen}
        return run
    return map_batches(rows.select("kind", "features"), make,
                       "kind string, features array<int>, chosen array<int>")


def one_per_copy_group(rows: DataFrame) -> DataFrame:
    """Training rows (kind, features) without near copies of one another: of rows
    of a kind that share their three least rare features (in at most 1 % of the
    kind's rows), the least."""
    rare = {kind: c <= max(5, n // 100) for kind, (n, c) in document_counts(rows).items()}
    least = F.slice(F.array_sort(F.array_distinct("chosen")), 1, 3)
    # a row without rare features is like no other
    group = F.when(F.size("chosen") > 0, F.xxhash64(least)).otherwise(F.xxhash64("features"))
    return (_narrowed(rows, rare).withColumn("group", group).groupBy("kind", "group")
            .agg(F.min(F.struct(F.size("features"), "features")).alias("first"))
            .select("kind", F.col("first.features").alias("features")))


def select_features(positives: tuple[int, np.ndarray], unlabelled: tuple[int, np.ndarray],
                    prior: float = 0.0,
                    least: int = 3, share: float = 0.01, z: float = 5.0) -> np.ndarray:
    """Which features separate the two sets (``document_counts``) beyond chance:
    at least ``least`` positives and ``share`` of them have it, by a
    two-proportion z. The toxic rows among the unlabelled ones, ``prior`` of
    them, shrink the difference to clean rows by that share, and ``z`` with it."""
    (n, a), (m, b) = positives, unlabelled
    pooled = (a + b) / (n + m)
    error = np.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m)) + 1e-12
    return (a >= max(least, share * n)) & ((a / n - b / m) / error > z * (1 - prior))


def risk(z: np.ndarray, pos: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the risk of margins ``z`` (``pos``: which are positives):
    the positives' own and the corrected one, which may come out below zero."""
    # softplus losses: l(-z) for "toxic", l(z) for "clean"
    own = prior * np.logaddexp(0, -z[pos]).mean()
    return own, np.logaddexp(0, z[~pos]).mean() - prior * np.logaddexp(0, z[pos]).mean()


def slope(z: np.ndarray, pos: np.ndarray, prior: float) -> np.ndarray:
    """Gradient of a step by margin: of the whole risk, or, where the corrected part
    is below zero, of that part turned round, which walks it back up."""
    p, n_pos = _sigmoid(z), int(pos.sum())
    g = np.empty(len(z))
    if risk(z, pos, prior)[1] >= 0:
        g[pos] = prior * (p[pos] - 1) / n_pos - prior * p[pos] / n_pos
        g[~pos] = p[~pos] / (len(z) - n_pos)
    else:
        g[pos] = prior * p[pos] / n_pos
        g[~pos] = -p[~pos] / (len(z) - n_pos)
    return g


def fit_nnpu(positives: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
             steps: int = 1000, rate: float = 0.05, shrink: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the non-negative risk with logistic loss;
    ``shrink`` pulls weights to zero (L1), so chance words keep none."""
    rows = positives + unlabelled
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    used, col = np.unique(feat, return_inverse=True)
    n, n_pos = len(rows), len(positives)
    pos = np.zeros(n, bool)
    pos[:n_pos] = True
    w, b = np.zeros(len(used)), 0.0
    m1, m2 = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, steps + 1):
        z = np.bincount(doc, w[col], n) + b
        g = slope(z, pos, prior)
        grad = np.append(np.bincount(col, g[doc], len(used)), g.sum())
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.999 * m2 + 0.001 * grad * grad
        delta = rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
        w -= delta[:-1]
        b -= delta[-1]
        w = np.sign(w) * np.maximum(np.abs(w) - shrink, 0)
    out = np.zeros(BUCKETS)
    out[used] = w
    return out, float(b)


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic curve through margins and 0/1 labels (Newton)."""
    if len(np.unique(labels)) < 2:
        return 1.0, 0.0
    center, spread = margins.mean(), margins.std() or 1.0
    x = np.column_stack(((margins - center) / spread, np.ones(len(margins))))
    # smoothed targets keep a separable fit finite
    k = labels.sum()
    y = np.where(labels == 1, (k + 1) / (k + 2), 1 / (len(labels) - k + 2))
    t = np.zeros(2)
    for _ in range(60):
        p = _sigmoid(x @ t)
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        t += np.linalg.solve(h, x.T @ (y - p) - 1e-6 * t)
    return float(t[0] / spread), float(t[1] - t[0] * center / spread)


def _features(docs: DataFrame) -> DataFrame:
    """__kind and the text's feature numbers, made on the executors."""
    def make():
        def run(batch: pa.RecordBatch) -> dict:
            return {"kind": batch.column(0), "features": [
                sorted(f for w in distinct_words(t) for f in features_of(w))
                for t in texts(batch.column(1))]}
        return run
    return map_batches(docs, make, "kind string, features array<int>")


def train(docs: DataFrame, labels: DataFrame, held_out, doc_id: str = "doc_id",
          text: str = "text", label: str = "toxic", limits: Limits = Limits()) -> Model:
    """``held_out``: a condition on doc_id; no label of such a row is used."""
    known = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).alias("__y")))
    ids = docs.where(~held_out & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("__id"))
    rows = (ids.join(known, "__id", "left")
            .withColumn("__h", F.xxhash64(F.col("__id").cast("string"), F.lit("toxicity")))
            .withColumn("__fold", F.pmod(F.shiftright("__h", 8), F.lit(4))))
    labelled = rows.where(F.col("__y").isNotNull())
    counts = labelled.agg(F.count(F.lit(1)).alias("n"), F.sum("__y").alias("k")).first()
    if not counts["k"]:
        return Model(np.zeros(BUCKETS), 0.0, 1.0, 0.0, empty=True)
    prior = float(counts["k"]) / counts["n"]

    def least(df: DataFrame, n: int, kind: str) -> DataFrame:
        return df.orderBy("__h", "__id").limit(n).select("__id", F.lit(kind).alias("__kind"))

    # a quarter calibrates; of the others all make the unlabelled population, and
    # the confirmed toxic ones the positives as well
    fit = rows.where("__fold <> 0")
    chosen = [least(fit.where("__y = 1"), limits.positives, "P"),
              least(fit, limits.unlabelled, "U"),
              least(labelled.where("__fold = 0 and __y = 1"), limits.calibration, "1"),
              least(labelled.where("__fold = 0 and __y <> 1"), limits.calibration, "0")]
    picked = chosen[0]
    for c in chosen[1:]:
        picked = picked.unionByName(c)
    # at most the sum of the limits in rows of an id and a letter: broadcast
    sample = (docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
              .join(F.broadcast(picked), "__id").select("__kind", "__text"))
    rows = staged(_features(sample), "toxicity-features")
    training = staged(one_per_copy_group(rows.where("kind in ('P', 'U')")), "toxicity-training")
    counts = document_counts(training)
    if counts.keys() != {"P", "U"}:
        return Model(np.zeros(BUCKETS), 0.0, 1.0, 0.0, empty=True)
    use = select_features(counts["P"], counts["U"], prior)
    # the driver gets the rows' chosen features only: some hundred numbers of them
    kept = _narrowed(training.unionByName(rows.where("kind in ('1', '0')")),
                     dict.fromkeys("PU10", use)).select("kind", F.col("chosen").alias("features")).toArrow()
    by: dict[str, list] = {k: [] for k in "PU10"}
    for kind, features in zip(kept["kind"].to_pylist(), kept["features"].to_pylist()):
        by[kind].append(np.array(features, np.int64))
    for v in by.values():               # rows arrive in any order
        v.sort(key=lambda a: (len(a), a.tolist()))
    w, b = fit_nnpu(by["P"], by["U"],
                    min(max(prior, 1e-4), 0.9))
    margins = np.array([b + w[r].sum() for r in by["1"] + by["0"]])
    scale, shift = calibrate(margins, np.repeat([1, 0], [len(by["1"]), len(by["0"])]))
    if by["1"] and by["0"]:
        # the kinds were drawn apart: move the odds back to their true shares
        drawn = len(by["1"]) / len(margins)
        shift += float(np.log(prior / (1 - prior)) - np.log(drawn / (1 - drawn)))
    return Model(w, b, scale, shift)


def score(docs: DataFrame, model: Model, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the score as an added column."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import DoubleType, StructType
    shared = Shared(docs.sparkSession, model)
    schema = StructType([*docs.schema.fields]).add(column, DoubleType())
    arrow, at = to_arrow_schema(schema), docs.columns.index(text)

    def run(batches):
        one = shared.load().scorer()
        for batch in batches:
            s = pa.array([one(t) for t in texts(batch.column(at))], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, s], schema=arrow)
        one = batch = s = None
        hand_back()

    return docs.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    return (bucket_of(F.col(doc_id), 3) == 1) & F.col(doc_id).isNotNull()


def filter_documents(docs: DataFrame, model: Model, text: str = "text",
                     threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below ``threshold``, with all their columns."""
    return score(docs, model, text, "__toxicity").where(
        F.col("__toxicity") < threshold).drop("__toxicity")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"), held_out())
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
