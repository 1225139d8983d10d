"""Language identification by averaged hashed subword embeddings.

A text is the average of the embeddings of its subwords: runs of 1 to 3 letters
within its words in lower case, the word's borders being letters too, hashed
into ``BUCKETS`` rows. A linear softmax over the average gives the language.
Embeddings and softmax are trained together by stochastic gradient descent in
numpy. As the average is linear, a trained model is one table of bucket by
language; every whole text is scored against it in tasks.

Training rows are bounded (``Limits``): of each language the different texts of
least hash, cut into runs of 1 to 64 words of which a text gives at most
``segments``, so that short texts are learned as well as long ones. A quarter of
the texts is kept out of training and calibrates, in runs and whole: the margin
is scaled by a power of the number of subwords (a longer text is surer), the
odds are moved to the languages' shares among all labelled rows, and the
rejection limit is the least score from which on at most ``Limits.error`` of
those whole texts are wrong.

Defined results: a null text, and one without a letter, is ``und`` with score 0,
and so is every text if no row can be learned from; a language is any non-null
lang value. Texts whose score is below the limit keep their most likely language
and are marked ``rejected``. Equal texts get equal results; repeated rows are
scored each; repeated texts of a language count once in training. A null id is
never learned from and never held out. Only id, text and lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clusterlens.llm.common import Shared, bucket_of, map_batches, table, texts

UNKNOWN = "und"
BUCKETS = 1 << 16
DIMENSIONS = 16
LONGEST = 3                     # letters of a subword
BLOCK = 1 << 20                 # characters looked at together
GATHERED = 1 << 21              # numbers gathered at a time
RUNS = (1, 2, 4, 8, 16, 32, 64)  # words of a training run
SALTS = 64
SEED = 11


@dataclass(frozen=True)
class Limits:
    """Texts of a language, texts of all languages, runs of a text; training;
    the share of wrong texts accepted by the rejection limit."""
    texts: int = 600
    all_texts: int = 6_000
    segments: int = 6
    epochs: int = 8
    rate: float = 1.0
    batch: int = 64
    error: float = 0.01


class Letters:
    """Which code points are letters, looked up once each."""

    def __init__(self):
        self.known = np.zeros(0x110000, np.int8)      # 0 not asked yet, 1 letter, 2 none

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        fresh = codes[self.known[codes] == 0]
        for c in np.unique(fresh).tolist():
            self.known[c] = 1 if chr(c).isalpha() else 2
        return self.known[codes] == 1


def subwords(values: list[str], letters: Letters) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, index of the text) of every subword of some texts."""
    lower = [v.lower() for v in values]
    codes = np.frombuffer(("\0" + "\0".join(lower) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(lower)), [len(v) + 1 for v in lower])
    owner = np.append(owner, max(len(lower) - 1, 0))
    letter = letters(codes)
    kept = letter.copy()                    # letters and the borders beside them
    kept[:-1] |= letter[1:]
    kept[1:] |= letter[:-1]
    codes, letter, owner = codes[kept].astype(np.uint64), letter[kept], owner[kept]
    codes[~letter] = 0
    out, own = [], []
    for n in range(1, LONGEST + 1):
        size = len(codes) - n + 1
        if size <= 0:
            break
        whole = letter[:size].copy() if n == 1 else np.ones(size, bool)
        for i in range(1, n - 1):
            whole &= letter[i:size + i]     # no border inside
        if n == 2:
            whole &= letter[:size] | letter[1:size + 1]
        at = np.flatnonzero(whole)
        h = np.full(len(at), n, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(n):
                h = (h ^ codes[at + i]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(32)
        out.append((h & np.uint64(BUCKETS - 1)).astype(np.int32))
        own.append(owner[at + ~letter[at]])     # a border may be the next text's
    if not out:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    bucket, own = np.concatenate(out), np.concatenate(own)
    order = np.argsort(own, kind="stable")
    return bucket[order], own[order]


def runs_of(text: str, seed: int, most: int) -> list[str]:
    """At most ``most`` runs of words drawn by hash from all of a text cut into
    runs of 1, 2, 4 .. 64 words, over and over."""
    words = text.split()
    cut, at, turn = [], 0, seed % len(RUNS)
    while at < len(words):
        cut.append(" ".join(words[at:at + RUNS[turn]]))
        at, turn = at + RUNS[turn], (turn + 1) % len(RUNS)
    drawn = np.random.default_rng(seed & 0x7FFFFFFF).permutation(len(cut))[:most]
    return [cut[i] for i in sorted(drawn)]


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray           # bucket by language: share of the margin
    bias: np.ndarray
    scale: np.ndarray           # log of the margin's scale: constant, by log of subwords
    prior: np.ndarray           # log odds to the true shares
    limit: float                # scores below it are rejected

    def margins(self, values: list[str], letters: Letters) -> tuple[np.ndarray, np.ndarray]:
        """(raw margins, number of subwords) per text."""
        bucket, own = subwords(values, letters)
        n = np.bincount(own, minlength=len(values))
        total = np.zeros((len(values), len(self.languages)))
        step = max(1, GATHERED // max(1, len(self.languages)))
        for lo in range(0, len(bucket), step):
            o = own[lo:lo + step]
            first = np.flatnonzero(np.diff(o, prepend=-1))
            total[o[first]] += np.add.reduceat(self.table[bucket[lo:lo + step]], first, axis=0)
        return total / np.maximum(n, 1)[:, None] + self.bias, n

    def probabilities(self, margins: np.ndarray, n: np.ndarray) -> np.ndarray:
        return softmax(scaled(margins, n, self.scale) + self.prior)

    def predict(self, values: list[str], letters: Letters) -> tuple[list[str], np.ndarray]:
        """Language and score per text."""
        if not self.languages:
            return [UNKNOWN] * len(values), np.zeros(len(values))
        margins, n = self.margins(values, letters)
        p = self.probabilities(margins, n)
        best = p.argmax(axis=1)
        score = np.where(n > 0, p[np.arange(len(p)), best], 0.0)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, n)], score


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def scaled(margins: np.ndarray, n: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return margins * np.exp(np.clip(scale[0] + scale[1] * np.log1p(n), -8, 8))[:, None]


def descend(rows: list[np.ndarray], y: np.ndarray, languages: int, limits: Limits
            ) -> tuple[np.ndarray, np.ndarray]:
    """Stochastic gradient descent on the softmax loss of averaged embeddings;
    (bucket by language, bias)."""
    rng = np.random.default_rng(SEED)
    e = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    w = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (DIMENSIONS, languages))
    b = np.zeros(languages)
    seen = np.zeros(BUCKETS, bool)
    steps = limits.epochs * -(-len(rows) // limits.batch)
    step = 0
    for _ in range(limits.epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), limits.batch):
            pick = order[lo:lo + limits.batch]
            size = np.array([len(rows[i]) for i in pick])
            used, at = np.unique(np.concatenate([rows[i] for i in pick]), return_inverse=True)
            own = np.repeat(np.arange(len(pick)), size)
            share = np.bincount(own * len(used) + at, minlength=len(pick) * len(used)
                                ).reshape(len(pick), len(used)) / size[:, None]
            mean = share @ e[used]
            g = softmax(mean @ w + b)
            g[np.arange(len(pick)), y[pick]] -= 1
            rate = limits.rate * (1 - step / steps)
            back = g @ w.T
            w -= rate * (mean.T @ g) / len(pick)
            b -= rate * g.mean(axis=0)
            # rows of the table are seldom met: they move by the sum over the batch
            e[used] -= rate * (share.T @ back)
            seen[used] = True
            step += 1
    e[~seen] = 0                    # what was never learned says nothing
    return e @ w, b


def calibrate(margins: np.ndarray, n: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The scale (constant, by length) of least log loss: descent with halving steps."""
    def loss(s: np.ndarray) -> float:
        p = softmax(scaled(margins, n, s))
        return float(-np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean() + 1e-3 * (s ** 2).sum())
    s, step = np.zeros(2), np.array([1.0, 0.25])
    best = loss(s)
    while step.max() > 1e-3:
        moved = False
        for i in range(2):
            for sign in (1, -1):
                t = s.copy()
                t[i] += sign * step[i]
                value = loss(t)
                if value < best - 1e-12:
                    s, best, moved = t, value, True
        if not moved:
            step = step / 2
    return s


def rejection_limit(score: np.ndarray, right: np.ndarray, error: float) -> float:
    """The least score from which on at most ``error`` of the texts are wrong."""
    order = np.argsort(-score, kind="stable")
    s, wrong = score[order], np.cumsum(~right[order])
    fine = wrong <= error * np.arange(1, len(s) + 1)
    fine &= np.append(s[1:] < s[:-1], True)         # equal scores stand together
    at = np.flatnonzero(fine)
    return float(s[at[-1]]) if len(at) else 1.0


def _sample(docs: DataFrame, held_out: Column, doc_id: str, text: str, lang: str, limits: Limits
            ) -> tuple[DataFrame | None, dict[str, int]]:
    rows = docs.where(~held_out & F.col(doc_id).isNotNull() & F.col(lang).isNotNull()
                      & (F.length(F.col(text)) > 0))
    named = rows.select(F.col(doc_id).alias("__id"), F.col(lang).cast("string").alias("__lang"),
                        F.xxhash64(text).alias("__h"))
    shares = {r["__lang"]: r["n"] for r in named.groupBy("__lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not shares:
        return None, shares
    if len(shares) > limits.all_texts // 4:
        raise ValueError(f"{len(shares)} languages are more than {limits.all_texts} training texts can teach")
    each = min(limits.texts, limits.all_texts // len(shares))
    different = (named.groupBy("__lang", "__h").agg(F.min("__id").alias("__id"))
                 .withColumn("__salt", F.pmod("__h", F.lit(SALTS))))
    order = ["__h", "__id"]
    picked = (different.withColumn("r", F.row_number().over(Window.partitionBy("__lang", "__salt").orderBy(*order)))
              .where(F.col("r") <= each)
              .withColumn("r", F.row_number().over(Window.partitionBy("__lang").orderBy(*order)))
              .where(F.col("r") <= each).select("__lang", "__h", "__id"))
    # at most all_texts rows of three short columns: broadcast
    sample = rows.select(F.col(doc_id).alias("__id"), F.col(lang).cast("string").alias("__lang"),
                         F.xxhash64(text).alias("__h"), F.col(text).alias("__text")).join(
        F.broadcast(picked), ["__id", "__lang", "__h"]).select("__lang", "__h", "__text")
    return sample, shares


def train(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang", limits: Limits = Limits()) -> Model:
    """``held_out``: a condition on the id; no row that meets it is learned from."""
    empty = Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), np.zeros(2), np.zeros(0), 1.0)
    sample, shares = _sample(docs, held_out, doc_id, text, lang, limits)
    if sample is None:
        return empty

    def make():
        letters = Letters()

        def run(batch: pa.RecordBatch) -> dict:
            out = {"lang": [], "h": [], "piece": [], "buckets": []}
            for name, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                     texts(batch.column(2))):
                pieces = runs_of(text, h & 0x7FFFFFFFFFFFFFFF, limits.segments)
                bucket, own = subwords(pieces, letters) if pieces else (np.zeros(0, np.int32),) * 2
                for i in range(len(pieces)):
                    mine = bucket[own == i].astype(np.uint16)
                    if len(mine):
                        out["lang"].append(name)
                        out["h"].append(h)
                        out["piece"].append(i)
                        out["buckets"].append(mine.tobytes())
            return out
        return run
    # bounded: at most all_texts * segments runs of 64 words
    rows = map_batches(sample, make, "lang string, h long, piece int, buckets binary").toArrow().to_pylist()
    rows = list({(r["lang"], r["h"], r["piece"]): r for r in rows}.values())
    rows.sort(key=lambda r: (r["h"], r["lang"], r["piece"]))
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return empty
    y = np.array([languages.index(r["lang"]) for r in rows])
    data = [np.frombuffer(r["buckets"], np.uint16).astype(np.int32) for r in rows]
    fold = np.array([r["h"] >> 8 & 3 for r in rows]) == 0
    if not fold.any() or len(set(y[~fold])) < len(languages):
        fold = np.zeros(len(rows), bool)        # too few texts to keep any out
    train_rows = [d for d, f in zip(data, fold) if not f]
    weights, bias = descend(train_rows, y[~fold], len(languages), limits)
    model = Model(languages, weights.astype(np.float32), bias, np.zeros(2), np.zeros(len(languages)), 0.0)
    check = fold if fold.any() else ~fold
    kept = [d for d, f in zip(data, check) if f]
    n = np.array([len(d) for d in kept])
    margins = np.array([weights[d].mean(axis=0) for d in kept]) + bias
    whole = whole_margins(sample, model, {r["h"] for r, f in zip(rows, check) if f})
    n = np.concatenate((n, whole["n"].to_numpy().astype(n.dtype)))
    margins = np.concatenate((margins, np.array(whole["margins"].to_pylist()).reshape(-1, len(languages))))
    right = np.concatenate((y[check], [languages.index(name) for name in whole["lang"].to_pylist()])).astype(int)
    model.scale = calibrate(margins, n, right)
    drawn = np.bincount(y, minlength=len(languages)) / len(y)
    true = np.array([shares[name] for name in languages], float)
    model.prior = np.log(true / true.sum()) - np.log(drawn)
    p, ends = model.probabilities(margins, n), slice(len(kept), None)
    if whole.num_rows:
        model.limit = rejection_limit(p[ends].max(axis=1), p[ends].argmax(axis=1) == right[ends], limits.error)
    return model


def whole_margins(sample: DataFrame, model: Model, chosen: set[int]) -> pa.Table:
    """(lang, h, n, margins) of the whole texts of the sample whose hash is chosen,
    each different text once."""
    shared = Shared(sample.sparkSession, (model, chosen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (m, wanted), letters = shared.load(), Letters()
        for batch in batches:
            for name, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                     texts(batch.column(2))):
                if h in wanted and name in m.languages:
                    margins, n = m.margins([text], letters)
                    if n[0]:
                        yield pa.RecordBatch.from_pydict({
                            "lang": [name], "h": pa.array([h], pa.int64()),
                            "n": pa.array([int(n[0])], pa.int64()), "margins": [margins[0].tolist()]})
    got = sample.mapInArrow(run, "lang string, h long, n long, margins array<double>")
    return got.dropDuplicates(["lang", "h"]).toArrow().sort_by([("h", "ascending"), ("lang", "ascending")])


def blocks(column: pa.Array) -> Iterator[list[str]]:
    """The texts of a column in lists of about ``BLOCK`` characters."""
    some, size = [], 0
    for t in texts(column):
        some.append(t)
        size += len(t)
        if size >= BLOCK:
            yield some
            some, size = [], 0
    if some:
        yield some


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected per document row."""
    shared = Shared(docs.sparkSession, model)
    kind = docs.schema[doc_id].dataType.simpleString()

    def make():
        m, letters = shared.load(), Letters()

        def run(batch: pa.RecordBatch) -> dict:
            names, scores = [], []
            for some in blocks(batch.column(1)):
                name, score = m.predict(some, letters)
                names += name
                scores += score.tolist()
            return {"doc_id": batch.column(0), "lang_pred": names, "score": scores,
                    "rejected": [s < m.limit for s in scores]}
        return run
    return map_batches(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), make,
                       f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def held_out(doc_id: str = "doc_id") -> Column:
    return (bucket_of(F.col(doc_id), 4) == 2) & F.col(doc_id).isNotNull()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, held_out())
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score",
                                       "rejected")
