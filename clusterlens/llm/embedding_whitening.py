"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become integers, x = floor(1024 * c) + 100000, so that counts, sums and
deviations are exact. The covariance V of x (divisor n) is never formed: a pass
over the rows gives V Q for a block Q of d x m doubles, each row centred before
it is multiplied, and a three-term Chebyshev recurrence of such passes damps
every direction whose eigenvalue lies below the block's least Ritz value. Then
QR, Rayleigh-Ritz, and again, until the residuals ``|V q - e q|`` of all wanted
pairs certify them. A pass sums within a task, then per cell in Spark: what
reaches the driver is d x m numbers, whatever the number of rows. The filter's
degree is held down where the first eigenvalue stands far above the rest, so
that one pass of the recurrence cannot drown the other columns.

Defined results: rows with a null vector, or one with a null or non-finite
entry, are dropped; other rows give one row per component, repeated rows and
ids as often as they occur. A component whose eigenvalue is zero (fewer
directions than components: few rows, equal vectors, narrow vectors) has no
direction and is not returned, so n equal vectors give no rows. Equal
eigenvalues have any orthonormal basis of their space. No remaining rows: an
empty result. Vectors of different widths, or entries beyond 2**40 in size, stop
the job, as there is no covariance of them to speak of; so does a deviation that
does not fit a long. Of a table only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.llm.common import staged, table

SCALE, SHIFT = 1_024, 100_000   # fixed values of the contract
LARGEST = 2.0 ** 40             # entries beyond it are refused
COMPONENTS = 8
GUARD = 24                      # columns beyond the wanted ones
DEGREE = 16                     # most passes of one recurrence
SPREAD = 23.0                   # log of the most by which a filter may stretch the first column
CERTIFIED = 1e-14               # residual by the first eigenvalue
FLOOR = 1e-11                   # accepted where rounding allows no less
CYCLES = 400
SEED = 20


def integers(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x array<long>) of the rows whose vector is whole and finite."""
    c = F.col(vector).cast("array<double>")
    whole = F.col(vector).isNotNull() & F.forall(
        c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    entry = lambda v: F.when(F.abs(v) < LARGEST, F.floor(v * F.lit(float(SCALE))) + SHIFT).otherwise(
        F.raise_error(F.lit("an entry of a vector is too large to whiten")).cast("long"))
    return df.where(whole).select(F.col(vec_id).alias("vec_id"), F.transform(c, entry).alias("x"))


@dataclass(frozen=True)
class Sums:
    """n, the sums per dimension (Python ints, exact) and the width."""
    n: int
    s: tuple[int, ...]

    @property
    def width(self) -> int:
        return len(self.s)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: 64-bit where that holds it, Python ints beyond."""
        big = max([abs(v) for v in self.s] + [self.n * int(np.abs(x).max(initial=0))])
        kind = np.int64 if big < 2 ** 61 else object
        return x.astype(kind) * self.n - np.array(self.s, dtype=kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return np.asarray(self.scaled(x), dtype=np.float64) / self.n

    def deviations(self, x: np.ndarray) -> np.ndarray:
        d = self.scaled(x)
        if d.dtype == object or self.width * float(np.abs(d).max(initial=0)) ** 2 >= 2.0 ** 62:
            d = (d.astype(object) ** 2).sum(axis=1)
            if max(d, default=0) >= 2 ** 63:
                raise OverflowError("a deviation does not fit a long")
            return d.astype(np.int64)
        return (d ** 2).sum(axis=1)


def sums_of(x: DataFrame) -> Sums | None:
    """Exact sums of the fit list, or None if it has no rows."""
    a = x.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("x")).alias("lo"),
              F.max(F.size("x")).alias("hi")).first()
    if not a["n"] or not a["hi"]:
        return None
    if a["lo"] != a["hi"]:
        raise ValueError(f"vectors of {a['lo']} to {a['hi']} entries cannot be whitened together")
    rows = (x.select(F.posexplode("x").alias("i", "v")).groupBy("i")
            .agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("s")).collect())
    return Sums(a["n"], tuple(int(r["s"]) for r in sorted(rows, key=lambda r: r["i"])))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def summed(x: DataFrame, sums: Sums, part: Callable[[np.ndarray], np.ndarray], shape: tuple) -> np.ndarray:
    """The sum over all rows of ``part(block of centred rows)``: one partial sum
    a task, added up per cell by Spark."""
    width = sums.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                p = part(sums.centred(matrix(batch.column(0), width)))
                total = p if total is None else total + p
        if total is not None:
            yield pa.RecordBatch.from_pydict({"cell": np.arange(total.size, dtype=np.int32),
                                              "v": total.ravel()})
    cells = (x.select("x").mapInArrow(run, "cell int, v double")
             .groupBy("cell").agg(F.sum("v").alias("v")).toArrow())
    out = np.zeros(int(np.prod(shape)))
    out[cells["cell"].to_numpy()] = cells["v"].to_numpy()
    return out.reshape(shape)


def covariance_times(x: DataFrame, sums: Sums, q: np.ndarray) -> np.ndarray:
    return summed(x, sums, lambda c: c.T @ (c @ q), q.shape) / sums.n


def chebyshev(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, degree: int,
              cut: float, top: float) -> np.ndarray:
    """The scaled Chebyshev filter of ``degree`` on [0, cut], of size one at ``top``."""
    half = cut / 2
    sigma1 = sigma = half / (top - half)
    before, y = q, (vq - half * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / sigma1 - sigma)
        before, y = y, 2 * (after / half) * (times(y) - half * y) - (sigma * after) * before
        sigma = after
    return y


@dataclass
class Components:
    values: np.ndarray          # eigenvalues, falling
    vectors: np.ndarray         # width x components
    residual: float             # largest, by the first eigenvalue
    passes: int


def subspace(times: Callable[[np.ndarray], np.ndarray], width: int, wanted: int = COMPONENTS,
             guard: int = GUARD) -> Components:
    """The leading eigenpairs of the operator ``times`` (positive semidefinite).

    A leading pair that is certified is locked: later blocks are held orthogonal
    to it, so an eigenvalue far above the others does not hold the filter down.
    """
    passes = 0
    locked, values, residuals = np.zeros((width, 0)), [], []

    def clear(y: np.ndarray) -> np.ndarray:
        return y - locked @ (locked.T @ y)

    def counted(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return clear(times(q))

    wanted = min(wanted, width)
    y = np.random.default_rng(SEED).standard_normal((width, min(width, wanted + guard)))
    best, stalled = np.inf, 0
    for _ in range(CYCLES):
        q, _r = np.linalg.qr(clear(clear(y)))
        vq = counted(q)
        theta, u = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        theta, u = theta[::-1], u[:, ::-1]
        q, vq = q @ u, vq @ u
        first = values[0] if values else theta[0]
        if first <= 0:
            return Components(np.zeros(0), np.zeros((width, 0)), 0.0, passes)
        left = np.linalg.norm(vq - q * theta, axis=0)[:wanted - len(values)] / first
        # no gain for some cycles, where little is left: that is rounding
        worst = left.max()
        stalled = 0 if worst < 0.8 * best else stalled + 1
        best = min(best, worst)
        done = left <= (FLOOR if stalled >= 4 else CERTIFIED)
        fine = len(done) if done.all() else int(done.argmin())
        if fine:
            values += theta[:fine].tolist()
            residuals += left[:fine].tolist()
            locked = np.column_stack((locked, q[:, :fine]))
            best, stalled = np.inf, 0
        if len(values) == wanted:
            break
        q, vq, theta = q[:, fine:], clear(vq[:, fine:]), theta[fine:]
        cut = max(theta[-1], 1e-9 * first)
        top = max(theta[0], cut)
        stretch = np.arccosh(max(2 * top / cut - 1, 1 + 1e-6))
        y = chebyshev(counted, q, vq, int(np.clip(SPREAD / stretch, 2, DEGREE)), cut, top)
    else:
        raise RuntimeError(f"residual {best:.1e} after {passes} passes")
    order = np.argsort(values)[::-1]
    order = order[np.array(values)[order] > width * 1e-14 * max(values)]
    return Components(np.array(values)[order], locked[:, order], float(max(residuals)), passes)


@dataclass
class Whitening:
    sums: Sums
    components: Components
    trace: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.project(self.sums.centred(x))

    def project(self, c: np.ndarray) -> np.ndarray:
        return (c @ self.components.vectors) / np.sqrt(self.components.values)


def fit(x: DataFrame, wanted: int = COMPONENTS, guard: int = GUARD) -> Whitening | None:
    """``x``: a staged result of ``integers``. None: nothing to fit."""
    sums = sums_of(x)
    if sums is None:
        return None
    # integer rows without spread have a trace of exactly zero
    trace = float(summed(x, sums, lambda c: np.array([(c ** 2).sum()]), (1,))[0]) / sums.n
    if trace == 0:
        return Whitening(sums, Components(np.zeros(0), np.zeros((sums.width, 0)), 0.0, 0), 0.0)
    found = subspace(lambda q: covariance_times(x, sums, q), sums.width, wanted, guard)
    return Whitening(sums, found, trace)


def identity_error(x: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    k, n = len(model.components.values), model.sums.n
    if not k:
        return 0.0
    mean = summed(x, model.sums, lambda c: model.project(c).sum(axis=0), (k,)) / n

    def part(c: np.ndarray) -> np.ndarray:
        w = model.project(c) - mean
        return w.T @ w
    return float(np.abs(summed(x, model.sums, part, (k, k)) / n - np.eye(k)).max())


def transform(x: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened array<double>) per row of ``x``."""
    kind = x.schema["vec_id"].dataType.simpleString()
    sums = model.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            m = matrix(batch.column(1), sums.width)
            w = model(m)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sums.deviations(m), pa.int64()),
                 pa.array(list(w), pa.list_(pa.float64()))], ["vec_id", "deviation", "whitened"])
    return x.select("vec_id", "x").mapInArrow(
        run, f"vec_id {kind}, deviation long, whitened array<double>")


def query(spark: SparkSession, sf_dir: str, name: str = "embeddings") -> DataFrame:
    return whitened_rows(table(spark, sf_dir, name))


def whitened_rows(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    x = staged(integers(embeddings, vec_id, vector), "whitening")
    model = fit(x)
    if model is None:
        kind = x.schema["vec_id"].dataType.simpleString()
        return embeddings.sparkSession.createDataFrame(
            [], f"vec_id {kind}, component int, n long, deviation long, whitened double, "
                "explained double, identity_error double")
    share = [float(v) / model.trace for v in model.components.values]
    explained = F.array(*map(F.lit, share)) if share else F.array().cast("array<double>")
    return (transform(x, model)
            .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"),
                    F.lit(model.sums.n).cast("long").alias("n"), "deviation", "whitened",
                    F.element_at(explained, F.col("at") + 1).alias("explained"),
                    F.lit(identity_error(x, model)).alias("identity_error")))
