"""Label distribution, per-dimension moments and z-score normalisation.

Moments are one grouped aggregate by dimension (``count/avg/stddev_pop``,
combined map-side with the stable central-moment merge), so only O(d)
partial rows per partition are shuffled. The fitted normaliser is O(d)
values and is applied as literal per-index arithmetic.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterlens.functions.vectors import affine, col_of, of_width, usable_scale


def label_counts(df: DataFrame, label_col: str = "label") -> DataFrame:
    """A1: records per label, largest first (ties by label)."""
    return (df.groupBy(label_col).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), F.asc(label_col)))


def vector_width(df: DataFrame, features: str = "features") -> int:
    """Width of the feature column; all non-null rows must agree."""
    r = df.agg(F.min(F.size(features)).alias("lo"),
               F.max(F.size(features)).alias("hi")).first()
    if r["hi"] is None or r["hi"] < 0:
        raise ValueError("no feature vectors")
    if r["lo"] != r["hi"]:
        raise ValueError(f"feature vectors of unequal width {r['lo']}..{r['hi']}")
    return int(r["hi"])


def feature_moments(df: DataFrame, features: str = "features",
                    dim: int | None = None) -> DataFrame:
    """A2: ``pos, n, mean, std`` per dimension (population std).

    ``posexplode`` + ``groupBy(pos)``: the generator stays inside whole-stage
    code generation and the partial aggregate holds one entry per dimension,
    so each partition sends d small rows to the shuffle. (Measured at 600k
    rows: 0.7 / 2.6 / 5.5 s for d = 14 / 64 / 128, against 1.2 / 5.7 / 13.9 s
    for one aggregate per dimension and 2.1 / 4.5 / 9.9 s for ``Summarizer``.)
    With ``dim`` every vector must have that width; one that has another
    stops the job instead of losing values.

    ``posexplode_outer``, not ``posexplode``: for the latter Catalyst infers
    ``features IS NOT NULL AND size(features) > 0`` and pushes it below the
    parse projection, which re-evaluates the whole parse inside the filter.
    Null vectors are dropped after the generator instead.
    """
    return _moments(df, features, dim).drop("vectors")


def _moments(df: DataFrame, features: str, dim: int | None) -> DataFrame:
    """The moments and ``vectors``, the number of vectors that have the position."""
    f = col_of(features) if dim is None else of_width(features, dim)
    exploded = (df.select(F.posexplode_outer(f).alias("pos", "x"))
                  .where(F.col("pos").isNotNull()))
    return (exploded.groupBy("pos")
              .agg(F.count("x").alias("n"), F.avg("x").alias("mean"),
                   F.stddev_pop("x").alias("std"), F.count(F.lit(1)).alias("vectors")))


@dataclass(frozen=True)
class Normalizer:
    """Per-dimension means and population stds.

    ``(x - mean) / std``; where std is 0, NaN or missing, ``x - mean``.
    """

    means: tuple[float, ...]
    stds: tuple[float | None, ...]
    n: int

    @property
    def dim(self) -> int:
        return len(self.means)

    @classmethod
    def fit(cls, df: DataFrame, features: str = "features",
            dim: int | None = None) -> "Normalizer":
        rows = _moments(df, features, dim).orderBy("pos").collect()
        if len({r["vectors"] for r in rows}) > 1:
            raise ValueError("feature vectors of unequal width")
        return cls(tuple(float(r["mean"]) if r["mean"] is not None else 0.0 for r in rows),
                   tuple(r["std"] for r in rows),
                   int(max((r["n"] for r in rows), default=0)))

    def column(self, features: str = "features") -> F.Column:
        return affine(features, self.means, self.stds)

    def apply(self, df: DataFrame, features: str = "features",
              out: str | None = None) -> DataFrame:
        return df.withColumn(out or features, self.column(features))

    def apply_to_centers(self, centers: DataFrame) -> DataFrame:
        return centers.withColumn("center", self.column("center"))

    def to_df(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [(i, float(m), float(s) if usable_scale(s) else None, self.n)
             for i, (m, s) in enumerate(zip(self.means, self.stds))],
            "pos int, mean double, std double, n long")


def zscore(df: DataFrame, features: str = "features",
           normalizer: Normalizer | None = None) -> DataFrame:
    """P11 with moments fitted on ``df`` itself unless a normaliser is given."""
    nz = normalizer or Normalizer.fit(df, features)
    return nz.apply(df, features)
