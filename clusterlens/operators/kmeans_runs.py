"""Many k-means runs over one reading of the points (K1, K2, K4-K8).

A run is a number of clusters and a seed. All runs of a fit (ten starts for one
k, or every k of a sweep) go through the data together: one job picks the first
centres of all of them, one job each the further rounds of k-means|| and each
Lloyd iteration, whatever the number of runs. A run that has converged leaves
the batch.

The result does not depend on how the points are partitioned:

* Equal vectors are one point with a weight, so a copy group of any size is one
  row, and a fit over distinct vectors equals a fit over all rows.
* A point's random number is a hash of (seed, round, point): of its id where one
  is given, else of its vector. k-means|| takes, in each round, the ``2 k``
  points of least ``-ln(u) / (weight * d²)``, d being the distance to the centres
  so far: D² sampling without replacement, in one pass, of a known size. The
  candidates are weighted by the points nearest to them and reclustered by
  weighted k-means++ (the same race) and Lloyd steps on the driver.
* Vector sums are integers: an entry is cut into two limbs of 26 bits on a scale
  fixed by the largest entry, so sums are exact and commute.

What reaches the driver is centres, never rows: at most
``runs * (1 + 2 k * rounds)`` candidates and the sums per centre.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clusterlens.functions.nearest import MAX_CENTER_VALUES, kernel_of, nearest_numpy
from clusterlens.functions.vectors import col_of

PRIME = 2 ** 31 - 1
LIMB = 26                   # bits of one limb of an entry
OVERSAMPLE = 2              # candidates of a round, per cluster
BLOCK = 4096                # points of a packed row
BLOCK_VALUES = 512 * 1024   # and entries of its vectors, at most
BALLS_FROM = 1536           # centres from which on balls take less time in a block
FEW_GROUPS = 8              # up to so many groups are summed by a product
LOCAL_STEPS = 30            # Lloyd steps when candidates are reclustered
# centre values of the runs that go through the data together; more runs take
# several batches
BATCH_VALUES = 16 * 1024 * 1024


@dataclass(frozen=True)
class Run:
    k: int
    seed: int


@dataclass(frozen=True)
class Fitted:
    run: Run
    centers: np.ndarray     # (k, d); fewer rows where there are fewer distinct points
    cost: float             # sum of squared distances to the nearest centre
    mean_distance: float
    n: int
    iterations: int


# ------------------------------------------------------------------ hashing

def coefficients(seed: int, tag: str) -> tuple[int, int, int, int]:
    """(a1, c1, a2, c2) of the hash ``(a x + c) mod PRIME`` for one draw."""
    h = hashlib.md5(f"{seed}:{tag}".encode()).hexdigest()
    a1, c1, a2, c2 = (int(h[i:i + 8], 16) % (PRIME - 1) + 1 for i in (0, 8, 16, 24))
    return a1, c1, a2, c2


def uniform(b1: np.ndarray, b2: np.ndarray, seed: int, tag: str) -> np.ndarray:
    """A number strictly between 0 and 1 per point, the same wherever it lies."""
    a1, c1, a2, c2 = coefficients(seed, tag)
    return ((a1 * b1 + c1) % PRIME + ((a2 * b2 + c2) % PRIME + 0.5) / PRIME) / PRIME


def race(b1: np.ndarray, b2: np.ndarray, seed: int, tag: str, weight: np.ndarray) -> np.ndarray:
    """Keys whose least ones are a sample without replacement by ``weight``."""
    with np.errstate(divide="ignore"):
        return np.where(weight > 0, -np.log(uniform(b1, b2, seed, tag)) / weight, np.inf)


# ------------------------------------------------------------------- points

def weighted_points(points: DataFrame, features: str = "features",
                    id_col: str | None = None) -> DataFrame:
    """``f, w, b1, b2``: distinct vectors, their number of rows and hash base.

    Rows without a vector, or with a null or non-finite entry, are left out.
    """
    f = col_of(features).cast("array<double>")
    extra = [F.min(F.col(id_col)).alias("__id")] if id_col else []
    # a least string takes a sort by the key; the hash before the vector decides
    # nearly all of its comparisons
    rows = (points.select(f.alias("f"), *([id_col] if id_col else []))
            .groupBy(F.xxhash64("f").alias("h"), "f").agg(F.count(F.lit(1)).alias("w"), *extra))
    # the count keeps the optimizer from moving this filter into the parse below,
    # which it would repeat for every reference to the vector
    rows = rows.where(F.when(F.col("w") > 0, F.col("f").isNotNull() & F.forall(
        "f", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))))
    if id_col:
        h = F.md5(F.col("__id").cast("string").cast("binary"))
        base = [F.conv(F.substring(h, at, 8), 16, 10).cast("bigint") % PRIME for at in (1, 9)]
    else:
        base = [F.pmod(F.xxhash64("f", F.lit(i)), F.lit(PRIME)) for i in (1, 2)]
    return rows.select("f", "w", base[0].alias("b1"), base[1].alias("b2"))


@dataclass(frozen=True)
class Shape:
    """Width, rows, and the power of two above the largest entry."""
    width: int
    n: int
    points: int
    exponent: int

    @property
    def square_exponent(self) -> int:
        """A power of two above any squared distance between two points."""
        return 2 * self.exponent + 2 + int(np.ceil(np.log2(max(self.width, 1))))


_BLOCK = ("rows long, points long, lo int, hi int, top double, "
          "f binary, w binary, b1 binary, b2 binary")


def packed(points: DataFrame) -> DataFrame:
    """``weighted_points`` in blocks of ``BLOCK`` points a row, fewer of wide vectors: their
    vectors, numbers of rows and hash bases as bytes, and what ``shape_of`` needs. Every pass hands
    blocks to its tasks, which costs far less than the points one by one. Blocks
    themselves pass as they are."""
    if "points" in points.columns:
        return points

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widest = pc.max(pc.list_value_length(batch.column(0))).as_py() or 1
            step = max(1, min(BLOCK, BLOCK_VALUES // widest))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                size = pc.list_value_length(part.column(0)).to_numpy(zero_copy_only=False)
                x = np.asarray(part.column(0).flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
                w, b1, b2 = (part.column(i).to_numpy(zero_copy_only=False).astype(np.int64)
                             for i in (1, 2, 3))
                yield pa.RecordBatch.from_pydict({
                    "rows": [int(w.sum())], "points": [len(w)], "lo": pa.array([int(size.min())], pa.int32()),
                    "hi": pa.array([int(size.max())], pa.int32()),
                    "top": [float(np.abs(x).max()) if len(x) else 0.0],
                    **{n: pa.array([v.tobytes()], pa.binary()) for n, v in zip(("f", "w", "b1", "b2"), (x, w, b1, b2))}})

    return points.select("f", "w", "b1", "b2").mapInArrow(pack, _BLOCK)


def _points_of(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The vectors of each block and, as integers, the other columns."""
    for block in zip(*(c for c in batch.columns)):
        x, *rest = (v.as_buffer() for v in block)
        yield (np.frombuffer(x, np.float64).reshape(-1, width), *(np.frombuffer(v, np.int64) for v in rest))


def shape_of(points: DataFrame) -> Shape | None:
    a = packed(points).agg(F.sum("rows").alias("n"), F.sum("points").alias("p"), F.min("lo").alias("lo"),
                           F.max("hi").alias("hi"), F.max("top").alias("top")).first()
    if not a["n"]:
        return None
    if a["lo"] != a["hi"]:
        raise ValueError(f"points have unequal widths {a['lo']}..{a['hi']}")
    top = a["top"] or 0.0
    return Shape(a["hi"], a["n"], a["p"], int(np.frexp(top)[1]) if top else 0)


def limbs(x: np.ndarray, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """``x = (high * 2**LIMB + low) * 2**(exponent - 2 LIMB)``, in integers."""
    scaled = _shifted(x, LIMB - exponent)
    high = np.rint(scaled)
    return high.astype(np.int64), np.rint(_shifted(scaled - high, LIMB)).astype(np.int64)


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    """``np.ldexp``; where the power of two is itself a number, by a product, which is
    as exact and faster."""
    return x * 2.0 ** by if abs(by) <= 1000 else np.ldexp(x, by)


def joined(high: np.ndarray, low: np.ndarray, exponent: int) -> np.ndarray:
    return np.ldexp(high.astype(np.float64), exponent - LIMB) + np.ldexp(
        low.astype(np.float64), exponent - 2 * LIMB)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False),
                      dtype=np.float64).reshape(len(column), width)


class _Sets:
    """Centre sets sent to the tasks once, released after use."""

    def __init__(self, points: DataFrame, sets: Sequence[np.ndarray]):
        self.handle = points.sparkSession.sparkContext.broadcast(list(sets))

    def __enter__(self):
        return self.handle

    def __exit__(self, *exc):
        self.handle.destroy()


# ------------------------------------------------------------------ seeding

_CHOSEN = "run int, key double, b1 long, b2 long, f array<double>"


def _least(points: DataFrame, shape: Shape, runs: Sequence[Run], sets: Sequence[np.ndarray] | None,
           tag: str, most: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per run the ``most`` points that come first in the race, by weight or, with
    centre sets, by weight times squared distance to the run's centres: (vectors,
    hash bases)."""
    width = shape.width

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [kernel_of(c, BALLS_FROM) for c in held.value]
        best: list[tuple | None] = [None] * len(runs)
        for x, w, b1, b2 in (block for batch in batches for block in _points_of(batch, width)):
            for r, run in enumerate(runs):
                weight = w if not known else w * known[r](x)[1] ** 2
                key = race(b1, b2, run.seed, tag, weight)
                at = np.flatnonzero(np.isfinite(key))
                if len(at) > most[r]:
                    at = at[np.argpartition(key[at], most[r] - 1)]
                    at = at[key[at] <= key[at[:most[r]]].max()]
                mine = (key[at], b1[at], b2[at], x[at])
                if best[r] is not None:
                    mine = tuple(np.concatenate(p) for p in zip(best[r], mine))
                order = np.lexsort((mine[2], mine[1], mine[0]))[:most[r]]
                best[r] = tuple(p[order] for p in mine)
        for r, b in enumerate(best):
            if b is not None and len(b[0]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(b[0]), r, np.int32)), pa.array(b[0]), pa.array(b[1]), pa.array(b[2]),
                     pa.array(list(b[3]), pa.list_(pa.float64()))], ["run", "key", "b1", "b2", "f"])

    with _Sets(points, sets or []) as held:
        found = packed(points).select("f", "w", "b1", "b2").mapInArrow(pick, _CHOSEN)
        place = F.row_number().over(Window.partitionBy("run").orderBy("key", "b1", "b2"))
        limit = F.element_at(F.array(*map(F.lit, most)), F.col("run") + 1)
        rows = found.withColumn("place", place).where(F.col("place") <= limit).toArrow()
    rows = rows.sort_by([("run", "ascending"), ("place", "ascending")])
    run = rows["run"].to_numpy()
    x = _matrix(rows["f"].combine_chunks(), width) if rows.num_rows else np.zeros((0, width))
    base = np.column_stack((rows["b1"].to_numpy(), rows["b2"].to_numpy()))
    return [(x[run == r], base[run == r]) for r in range(len(runs))]


def recluster(x: np.ndarray, weight: np.ndarray, base: np.ndarray, run: Run) -> np.ndarray:
    """Weighted k-means++ and Lloyd steps over a run's candidates."""
    d2 = np.ones(len(x))
    picked: list[int] = []
    for j in range(run.k):
        key = race(base[:, 0], base[:, 1], run.seed, f"pick{j}", weight * d2)
        best = np.lexsort((base[:, 1], base[:, 0], key))[0]
        if not np.isfinite(key[best]):
            break                       # fewer distinct candidates than clusters
        picked.append(int(best))
        diff = x - x[best]
        new = np.einsum("ij,ij->i", diff, diff)
        d2 = new if j == 0 else np.minimum(d2, new)
    centers = x[picked].copy()
    before = None
    for _ in range(LOCAL_STEPS):
        near, _d = nearest_numpy(x, centers)
        if before is not None and (near == before).all():
            break
        before = near
        total = np.zeros_like(centers)
        np.add.at(total, near, x * weight[:, None])
        mass = np.bincount(near, weights=weight, minlength=len(centers))
        live = mass > 0
        centers[live] = total[live] / mass[live][:, None]
    return centers


def seed_centers(points: DataFrame, shape: Shape, runs: Sequence[Run], rounds: int) -> list[np.ndarray]:
    """k-means|| starts of all runs: one pass for the first centres, one a round,
    one for the weights."""
    sets = _least(points, shape, runs, None, "first", [1] * len(runs))
    for i in range(rounds):
        more = _least(points, shape, runs, [x for x, _b in sets], f"round{i}",
                      [OVERSAMPLE * r.k for r in runs])
        sets = [(np.vstack((x, nx)), np.vstack((b, nb))) for (x, b), (nx, nb) in zip(sets, more)]
    near = scan(points, shape, [x for x, _b in sets], sums=False)
    return [recluster(x, s.rows.astype(np.float64), b, run)
            for (x, b), s, run in zip(sets, near, runs)]


# -------------------------------------------------------------------- passes

@dataclass
class Scan:
    """What one reading of the points says about one centre set."""
    rows: np.ndarray        # rows nearest to each centre
    sums: np.ndarray        # and the sum of their vectors, where asked for
    cost: float
    distance: float         # sum of distances


def group_sums(values: np.ndarray) -> Callable[[np.ndarray, int], np.ndarray]:
    """(group of each row, number of groups) to the sums of the rows of integers by
    group. Where no sum can pass 2**53 doubles add them, which is as exact, in any
    order, and needs no sort."""
    if np.abs(values).sum(axis=0, dtype=np.float64).max(initial=0.0) < 2.0 ** 52:
        held = values.astype(np.float64)
        columns = np.ascontiguousarray(held.T)

        def sums(group: np.ndarray, n: int) -> np.ndarray:
            if n <= FEW_GROUPS:
                found = (group == np.arange(n)[:, None]).astype(np.float64) @ held
            else:
                found = np.column_stack([np.bincount(group, weights=c, minlength=n) for c in columns])
            return found.astype(np.int64)
    else:
        def sums(group: np.ndarray, n: int) -> np.ndarray:
            order = np.argsort(group, kind="stable")
            first = np.flatnonzero(np.diff(group[order], prepend=-1))
            found = np.zeros((n, values.shape[1]), np.int64)
            found[group[order][first]] = np.add.reduceat(values[order], first, axis=0)
            return found
    return sums


def scan(points: DataFrame, shape: Shape, sets: Sequence[np.ndarray], sums: bool = True) -> list[Scan]:
    """One job: sizes, vector sums (unless ``sums`` is off) and costs of every centre set.

    A task sums what it reads into one row of integers per centre (and one per
    set for the costs); the rows of a centre are added up after one shuffle.
    """
    width, size = shape.width, [len(s) for s in sets]
    start = np.concatenate(([0], np.cumsum([n + 1 for n in size]))).astype(int)
    square, e = shape.square_exponent, shape.exponent
    root = square // 2 + 1
    held_sums = width if sums else 0
    entries = max(1 + 2 * held_sums, 5)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kernels = None, [kernel_of(c, BALLS_FROM) for c in held.value]
        for x, w in (block for batch in batches for block in _points_of(batch, width)):
            if total is None:
                total = np.zeros((start[-1], entries), np.int64)
            parts = limbs(x, e) if sums else ()
            grouped = group_sums(np.column_stack((np.ones(len(x), np.int64), *parts)) * w[:, None])
            for s, kernel in enumerate(kernels):
                near, dist = kernel(x)
                total[start[s]:start[s] + size[s], :1 + 2 * held_sums] += grouped(near, size[s])
                costs = [v @ w for v in (*limbs(dist ** 2, square), *limbs(dist, root))]
                total[start[s] + size[s], :4] += costs
        if total is not None:
            live = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(live.astype(np.int32)), pa.array(list(total[live]), pa.list_(pa.int64()))], ["c", "v"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            v = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1) if batch.num_rows else ()
            for c, row in zip(batch.column(0).to_pylist(), v):
                total[c] = total[c] + row if c in total else row.copy()
        if total:
            yield pa.RecordBatch.from_pydict({
                "c": pa.array(list(total), pa.int32()),
                "v": pa.array(list(total.values()), pa.list_(pa.int64()))})

    with _Sets(points, sets) as held:
        got = (packed(points).select("f", "w").mapInArrow(add, "c int, v array<bigint>")
               .repartition("c").mapInArrow(merge, "c int, v array<bigint>").toArrow())
    total = np.zeros((start[-1], entries), np.int64)
    if got.num_rows:
        total[got["c"].to_numpy()] = got["v"].combine_chunks().flatten().to_numpy().reshape(got.num_rows, -1)
    out = []
    for s, n in enumerate(size):
        rows = total[start[s]:start[s] + n]
        cost = total[start[s] + n]
        out.append(Scan(rows[:, 0], joined(rows[:, 1:1 + held_sums], rows[:, 1 + held_sums:1 + 2 * held_sums], e),
                        float(joined(cost[0:1], cost[1:2], square)[0]),
                        float(joined(cost[2:3], cost[3:4], root)[0])))
    return out


def iterate(points: DataFrame, shape: Shape, starts: Sequence[np.ndarray], tol: float, max_iter: int
            ) -> list[tuple[np.ndarray, int]]:
    """Lloyd iterations of all runs, one job each; a run whose centres moved by
    at most ``tol`` is done. A centre without rows stays where it is."""
    centers = [c.copy() for c in starts]
    steps = [0] * len(centers)
    open_ = [r for r, c in enumerate(centers) if len(c)]
    for _ in range(max_iter):
        if not open_:
            break
        still = []
        for r, s in zip(open_, scan(points, shape, [centers[r] for r in open_])):
            new = centers[r].copy()
            live = s.rows > 0
            new[live] = s.sums[live] / s.rows[live][:, None]
            moved = np.sqrt(((new - centers[r]) ** 2).sum(axis=1)).max()
            centers[r], steps[r] = new, steps[r] + 1
            if moved > tol:
                still.append(r)
        open_ = still
    return list(zip(centers, steps))


def distances(points: DataFrame, centers: np.ndarray) -> DataFrame:
    """``dist, w``: every point's distance to the nearest centre, its number of rows."""
    handle = points.sparkSession.sparkContext.broadcast(centers)
    width = centers.shape[1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = kernel_of(handle.value)
        for x, w in (block for batch in batches for block in _points_of(batch, width)):
            yield pa.RecordBatch.from_pydict({"dist": pa.array(kernel(x)[1]), "w": pa.array(w)})

    return packed(points).select("f", "w").mapInArrow(measure, "dist double, w long")


def _batches(runs: Sequence[Run], width: int, rounds: int) -> Iterator[list[Run]]:
    """Runs that go through the data together."""
    batch, values = [], 0
    for run in runs:
        mine = (1 + OVERSAMPLE * run.k * max(rounds, 1)) * max(width, 1)
        if mine > MAX_CENTER_VALUES:
            raise ValueError(f"k = {run.k} with {width} dims exceeds {MAX_CENTER_VALUES} candidate values")
        if batch and values + mine > BATCH_VALUES:
            yield batch
            batch, values = [], 0
        batch.append(run)
        values += mine
    if batch:
        yield batch


def fit_runs(points: DataFrame, runs: Sequence[Run], tol: float, max_iter: int, rounds: int) -> list[Fitted]:
    """All runs over ``weighted_points``, ``packed`` and persisted by the caller, in
    their order."""
    shape = shape_of(points)
    if shape is None:
        raise ValueError("no points to fit")
    out = []
    for batch in _batches(runs, shape.width, rounds):
        starts = seed_centers(points, shape, batch, rounds)
        done = iterate(points, shape, starts, tol, max_iter)
        final = scan(points, shape, [c for c, _n in done])
        out += [Fitted(run, c, s.cost, s.distance / shape.n, shape.n, n)
                for run, (c, n), s in zip(batch, done, final)]
    return out


def best_of(fits: Sequence[Fitted]) -> Fitted:
    """Lowest cost; the earliest seed wins a tie."""
    return min(fits, key=lambda f: (f.cost, f.run.seed))


# -------------------------------------------------------------------- scoring

def makeups(points: DataFrame, sets: dict[int, np.ndarray], features: str = "features",
            label_col: str = "label") -> DataFrame:
    """A4 for several models in one reading: ``k, cluster, label, count``, the
    key of ``sets`` as k. A task counts before anything is shuffled."""
    f = col_of(features).cast("array<double>")
    keys = list(sets)
    width = next((c.shape[1] for c in sets.values()), 0)
    handle = points.sparkSession.sparkContext.broadcast([sets[k] for k in keys])
    kind = points.schema[label_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernels = [kernel_of(c) for c in handle.value]
        for batch in batches:
            if not batch.num_rows:
                continue
            column, label = batch.column(0), batch.column(1)
            fine = pc.fill_null(pc.equal(pc.list_value_length(column), width), False)
            column, label = column.filter(fine), label.filter(fine)
            x = _matrix(column, width)          # a null entry reads as NaN
            fine = np.isfinite(x).all(axis=1)
            x, label = x[fine], label.filter(pa.array(fine)).dictionary_encode()
            code = label.indices.fill_null(len(label.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
            names = pa.concat_arrays([label.dictionary, pa.nulls(1, label.dictionary.type)])
            base = len(names)
            for k, kernel in zip(keys, kernels):
                pair, n = np.unique(kernel(x)[0] * base + code, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pair), k, np.int32)), pa.array((pair // base).astype(np.int32)),
                     names.take(pa.array(pair % base)), pa.array(n.astype(np.int64))],
                    ["k", "cluster", label_col, "count"])
    return (points.select(f.alias("f"), label_col)
            .mapInArrow(count, f"k int, cluster int, `{label_col}` {kind}, count bigint")
            .groupBy("k", "cluster", label_col).agg(F.sum("count").alias("count")))
