"""Column expressions over ``ARRAY<DOUBLE>`` feature vectors.

Everything here is a built-in Spark expression, so it runs inside the JVM.
Where the width is known on the driver the expression is unrolled into
plain per-index arithmetic (fully code-generated); otherwise it falls back
to higher-order functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Above this width unrolled per-index expressions make generated code too
# large; use the higher-order form instead.
UNROLL_LIMIT = 256


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double_array(c: str | Column) -> Column:
    """Any numeric array to ``ARRAY<DOUBLE>`` (float32 embeddings included)."""
    return col_of(c).cast("array<double>")


def distance(a: str | Column, b: str | Column) -> Column:
    """Euclidean distance; null when the widths differ or either is null.

    (The reference silently truncated to the shorter vector; a width
    mismatch is a data error, so it yields null here.)
    """
    a, b = col_of(a), col_of(b)
    sq = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    total = F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v)
    return F.when(F.size(a) == F.size(b), F.sqrt(total))


def usable_scale(s: float | None) -> bool:
    """A scale divides only when it is a positive number (not 0, NaN, null)."""
    return s is not None and s == s and s > 0


def affine(c: str | Column, shift: Sequence[float],
           scale: Sequence[float | None]) -> Column:
    """``(x_i - shift_i) / scale_i`` per element, ``x_i - shift_i`` where the
    scale is missing. Unrolled when the width is small enough."""
    c = col_of(c)
    dim = len(shift)
    if dim <= UNROLL_LIMIT:
        parts = []
        for i in range(dim):
            centred = F.get(c, i) - F.lit(float(shift[i]))
            s = scale[i]
            parts.append(centred / F.lit(float(s)) if usable_scale(s) else centred)
        return F.when(F.size(c) == dim, F.array(*parts))
    shift_arr = F.array(*[F.lit(float(v)) for v in shift])
    scale_arr = F.array(*[F.lit(float(s) if usable_scale(s) else 0.0)
                          for s in scale])

    def one(x, i):
        centred = x - F.get(shift_arr, i)
        sc = F.get(scale_arr, i)
        return F.when(sc > 0, centred / sc).otherwise(centred)

    return F.when(F.size(c) == dim, F.transform(c, one))


def of_width(c: str | Column, dim: int) -> Column:
    """``c`` itself; a vector of another width stops the job (a null passes)."""
    c = col_of(c)
    wrong = F.concat(F.lit(f"feature vector of another width than {dim}: "),
                     F.size(c).cast("string"))
    return F.when(c.isNull() | (F.size(c) == dim), c).otherwise(
        F.raise_error(wrong).cast("array<double>"))
