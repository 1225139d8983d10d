"""Global positions and running sums without a single-task window.

A window with ``orderBy`` but no ``partitionBy`` moves every row into one
task. Here the rows are instead sorted by Spark (range-partitioned on the
sort keys, sorted within partitions) and numbered inside each partition
(``monotonically_increasing_id`` encodes partition index and position).
That numbered result is checkpointed to the shared folder, so the numbering
stays fixed if parts are recomputed after an executor loss. Then only one
count (and one sum) per partition reaches the driver; the global position
is the partition's offset plus the local position, and a running sum is the
partition's offset plus a running sum within that one partition.

Make the sort keys a total order (add a tie-breaker), otherwise ties are
numbered in an arbitrary order.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clusterlens.session import checkpoint_root

_LOCAL_BITS = 33  # monotonically_increasing_id: partition index << 33 | row index


def _offsets(values: dict[int, float]) -> Column:
    """Literal map partition -> sum of the values of all earlier partitions."""
    pids = sorted(values)
    before = [0] + list(accumulate(values[p] for p in pids))[:-1]
    args = []
    for p, b in zip(pids, before):
        args += [F.lit(p), F.lit(b)]
    return F.create_map(*args)


def positions(df: DataFrame, keys: list[Column], pos_col: str = "pos",
              value_col: str | None = None, cum_col: str = "cum") -> DataFrame:
    """Add the 0-based position in the order of ``keys`` and, when
    ``value_col`` is given, the running sum of it up to and including the row.
    """
    checkpoint_root(df.sparkSession)  # makes sure a checkpoint folder is set
    numbered = (df.orderBy(*keys)
                  .withColumn("_mid", F.monotonically_increasing_id())
                  .checkpoint(eager=True))
    pid = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    local = F.col("_mid").bitwiseAND((1 << _LOCAL_BITS) - 1)
    aggs = [F.count(F.lit(1)).alias("c")]
    if value_col is not None:
        aggs.append(F.sum(value_col).alias("s"))
    totals = numbered.groupBy(pid.alias("_pid")).agg(*aggs).collect()  # one row per partition
    if not totals:
        out = numbered.withColumn(pos_col, F.lit(None).cast("bigint"))
        if value_col is not None:
            out = out.withColumn(cum_col, F.lit(None).cast("double"))
        return out.drop("_mid")
    counts = _offsets({int(r["_pid"]): int(r["c"]) for r in totals})
    out = numbered.withColumn(pos_col, (F.element_at(counts, pid) + local).cast("bigint"))
    if value_col is not None:
        sums = _offsets({int(r["_pid"]): float(r["s"] or 0.0) for r in totals})
        w = (Window.partitionBy(pid).orderBy("_mid")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        out = out.withColumn(cum_col, F.element_at(sums, pid) + F.sum(value_col).over(w))
    return out.drop("_mid")
