"""Seeded splits and samples (M1, M2).

``randomSplit`` depends on how the input happens to be partitioned, so the
default split is a hash split: a record's place is the first 32 bits of
``md5("<seed>:<id>")``, the same wherever and however often it is computed
(and reproducible in SQL). It is a per-row expression: no shuffle. The
bootstrap draws its Poisson counts from the same kind of hash.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterlens.functions.vectors import col_of

BUCKETS = 1 << 32


def hash_bucket(id_col: str | Column, seed: int, buckets: int = BUCKETS) -> Column:
    key = F.concat_ws(":", F.lit(str(seed)), col_of(id_col).cast("string"))
    h = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return h if buckets == BUCKETS else h % buckets


def split_index(id_col: str | Column, weights: Sequence[float], seed: int,
                buckets: int = BUCKETS) -> Column:
    """Which part of ``weights`` (normalised) each record falls into."""
    total = float(sum(weights))
    if total <= 0 or any(w < 0 for w in weights):
        raise ValueError("weights must be non-negative with a positive sum")
    bounds = [round(c / total * buckets) for c in accumulate(weights)][:-1]
    b = hash_bucket(id_col, seed, buckets)
    out = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        out = F.when(b < bounds[i], F.lit(i)).otherwise(out)
    return out.cast("int")


def hash_split(df: DataFrame, weights: Sequence[float], seed: int,
               id_col: str = "id") -> list[DataFrame]:
    """M1: deterministic split of ``df`` into ``len(weights)`` parts."""
    tagged = df.withColumn("_part", split_index(id_col, weights, seed))
    return [tagged.where(F.col("_part") == i).drop("_part") for i in range(len(weights))]


def poisson_bounds(mean: float) -> list[int]:
    """Places (of 2^32) at which a Poisson count of that mean rises by one."""
    if not 0 <= mean <= 700:
        raise ValueError("fraction must be between 0 and 700")
    p = below = math.exp(-mean)
    out, k = [], 0
    while round(below * BUCKETS) < BUCKETS and k < mean + 40 * math.sqrt(mean + 1):
        out.append(round(below * BUCKETS))
        k += 1
        p *= mean / k
        below += p
    return out


def bootstrap_sample(df: DataFrame, fraction: float, seed: int,
                     id_col: str = "id") -> DataFrame:
    """M2: sample with replacement: each record ``fraction`` times on average,
    its Poisson count taken from the hash of its id, so the sample does not
    depend on the partition layout."""
    h = hash_bucket(id_col, seed)
    count = F.lit(0)
    for b in poisson_bounds(fraction):
        count = count + (h >= b).cast("int")
    copies = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(
        F.array().cast("array<int>"))
    return df.withColumn("_copy", F.explode(copies)).drop("_copy")
