"""Category dictionaries that grow with a stream.

A value gets the next free index of its field in the batch that brings it
first (values of one batch in order) and keeps it: later batches only append.
What a batch adds depends on the entries of the batches before it alone, so a
replay or a restart gives the same indices. One-hot vectors made by an earlier
dictionary stay valid: ``widen`` pads their blocks to the widths of a later one.

Defined results: null values have no entry; a line of another width brings the
values it has; an empty batch adds nothing; a field with more than
``MAX_CATEGORIES`` values stops the stream before the batch is entered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clusterlens.functions.vectors import col_of
from clusterlens.operators import encode
from clusterlens.schema import RecordLayout
from clusterlens.streaming.delta_log import DeltaLog


def _earliest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("field", "value").agg(F.min("idx").alias("idx"))


class StreamDictionary:
    def __init__(self, spark: SparkSession, root: str, layout: RecordLayout,
                 line_col: str = "line", every: int = 16):
        self.log = DeltaLog(spark, root, "field int, value string, idx int", _earliest, every)
        self.layout, self.line_col = layout, line_col

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Enter the values that ``batch`` brings first."""
        known, sizes = self.dictionary(batch_id), self.sizes(batch_id)
        fresh = (encode.fit_categories(batch, self.layout, self.line_col).drop("idx")
                 .join(known, ["field", "value"], "left_anti")).persist()
        try:
            for r in fresh.groupBy("field").count().collect():      # a row per field
                if sizes.get(r["field"], 0) + r["count"] > encode.MAX_CATEGORIES:
                    raise ValueError(f"categorical field {r['field']} has too many values")
            taken = F.lit(0)
            for field, n in sizes.items():
                taken = F.when(F.col("field") == field, n).otherwise(taken)
            place = F.row_number().over(Window.partitionBy("field").orderBy("value")) - 1
            self.log.append(fresh.select(F.col("field").cast("int").alias("field"), "value",
                                         (place + taken).cast("int").alias("idx")), batch_id)
        finally:
            fresh.unpersist()

    def dictionary(self, before: int | None = None) -> DataFrame:
        """``field, value, idx`` after all batches (below ``before``), as
        ``fit_categories`` gives it."""
        return self.log.state(before)

    def sizes(self, before: int | None = None) -> dict[int, int]:
        """Entries per field: the widths of the one-hot blocks."""
        counts = self.dictionary(before).groupBy("field").count().collect()
        return {r["field"]: r["count"] for r in counts}

    def encode(self, df: DataFrame, before: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
        """P4 by the dictionary of the batches below ``before``."""
        return encode.parse_mixed(df, self.layout, self.dictionary(before), self.line_col, keep)


def widen(features: str | Column, layout: RecordLayout, old: dict[int, int], new: dict[int, int]) -> Column:
    """A vector encoded with block widths ``old`` in the widths ``new``: every
    block grows by zeros at its end. A vector of another width than ``old``'s stops the job."""
    f = col_of(features) if isinstance(features, str) else features
    pieces, start, run = [], 0, 0           # entries [start, start + run) go over as they are
    for i in range(layout.width):
        if i == layout.label_pos:
            continue
        run += old.get(i, 0) if i in layout.categorical else 1
        grown = new.get(i, 0) - old.get(i, 0) if i in layout.categorical else 0
        if grown < 0:
            raise ValueError(f"field {i} has fewer values in the later dictionary")
        if grown:
            pieces += [F.slice(f, start + 1, run), F.array_repeat(F.lit(0.0), grown)]
            start, run = start + run, 0
    pieces.append(F.slice(f, start + 1, run))
    width = start + run
    return (F.when(F.size(f) == width, F.concat(*pieces))
            .when(f.isNotNull(), F.raise_error(F.lit(f"a vector is not {width} wide"))))
