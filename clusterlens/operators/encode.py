"""Category dictionaries and one-hot encoding.

A dictionary is the sorted distinct values of each categorical field,
indexed from 0 (alphabetical, so it does not depend on partition order as
the reference's ``distinct().collect().zipWithIndex`` did). Distinct values
are found with a map-side-combined aggregate, so a value holding a third of
all rows is one entry per partition. The dictionary is a one-hot width, so
it must be small; it is applied as a map literal when small and through a
join otherwise. An unseen value gives an all-zero block and sets ``unseen``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clusterlens.operators.parse import _all_present, _finite, split_fields
from clusterlens.schema import RecordLayout

# A one-hot block wider than this is not a feature encoding any more.
MAX_CATEGORIES = 100_000
# Dictionaries up to this many entries (all columns) are inlined as map
# literals; larger ones are joined.
MAP_LITERAL_LIMIT = 20_000
# Blocks up to this width are unrolled into per-slot expressions.
_UNROLL_BLOCK = 64


def fit_categories(df: DataFrame, layout: RecordLayout,
                   line_col: str = "line") -> DataFrame:
    """``field, value, idx`` for every categorical position."""
    # the line is split in a step of its own, once and not for every field
    fields = df.select(split_fields(line_col, layout.sep).alias("_fields"))
    pairs = F.array(*[F.struct(F.lit(i).alias("field"), F.get("_fields", F.lit(i)).alias("value"))
                      for i in layout.categorical])
    distinct = (fields.select(F.inline(pairs))
                  .where(F.col("value").isNotNull())
                  .distinct())
    w = Window.partitionBy("field").orderBy("value")
    return distinct.withColumn("idx", (F.row_number().over(w) - 1).cast("int"))


@dataclass(frozen=True)
class CategoryIndex:
    """Driver view of the dictionaries: sizes always, and the
    ``column -> value -> idx`` maps when small enough to inline."""

    sizes: dict[int, int]
    maps: dict[int, dict[str, int]] | None

    @classmethod
    def from_df(cls, dictionary: DataFrame) -> "CategoryIndex":
        held = dictionary.is_cached
        dictionary.persist()        # fitted once for the check and the collect
        try:
            counts = {int(r["field"]): int(r["count"])
                      for r in dictionary.groupBy("field").count().collect()}
            too_big = {c: n for c, n in counts.items() if n > MAX_CATEGORIES}
            if too_big:
                raise ValueError(f"categorical fields with too many values: {too_big}")
            maps = None
            if sum(counts.values()) <= MAP_LITERAL_LIMIT:
                maps = {c: {} for c in counts}
                for r in dictionary.collect():
                    maps[int(r["field"])][r["value"]] = int(r["idx"])
        finally:
            if not held:
                dictionary.unpersist()
        return cls(counts, maps)

    def size(self, column: int) -> int:
        return self.sizes.get(column, 0)


def one_hot(idx: Column, n: int) -> Column:
    """``n`` doubles, 1.0 at ``idx``; a null index gives all zeros."""
    if n == 0:
        return F.array().cast("array<double>")
    if n <= _UNROLL_BLOCK:
        return F.array(*[F.when(idx == j, 1.0).otherwise(0.0) for j in range(n)])
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda j: F.when(j == idx, 1.0).otherwise(0.0))


def category_index(index: CategoryIndex, field: int, value: Column) -> Column:
    """The dictionary index of ``value`` for ``field`` (null when unseen);
    needs an index small enough to inline (``index.maps`` set)."""
    if index.maps is None:
        raise ValueError("dictionary too large to inline; use parse_mixed (joins)")
    return F.try_element_at(_map_literal(index.maps.get(field, {})), value)


def _map_literal(m: dict[str, int]) -> Column:
    args = []
    for k in sorted(m):
        args += [F.lit(k), F.lit(m[k])]
    return F.create_map(*args) if args else F.create_map().cast("map<string,int>")


def parse_mixed(df: DataFrame, layout: RecordLayout, dictionary: DataFrame,
                line_col: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """``label``, ``features`` = numeric fields in order with each
    categorical field replaced by its one-hot block (for the reference layout:
    ``[f0, protocol*, service*, flag*, f4, ...]``), ``unseen``, ``ok``."""
    index = CategoryIndex.from_df(dictionary)
    fs = "_fields"
    base = df.withColumn(fs, split_fields(line_col, layout.sep))
    # every field is looked up or read once, in a step before those that use it often
    base = base.withColumns({f"_n{i}": F.get(F.col(fs), i).try_cast("double")
                             for i in layout.numeric})
    idx_cols = {}
    if index.maps is not None:
        base = base.withColumns({
            f"_i{c}": F.try_element_at(_map_literal(index.maps.get(c, {})), F.get(F.col(fs), c))
            for c in layout.categorical})
        idx_cols = {c: F.col(f"_i{c}") for c in layout.categorical}
    else:
        for c in layout.categorical:
            d = (dictionary.where(F.col("field") == c)
                 .select(F.col("value").alias(f"_v{c}"), F.col("idx").alias(f"_i{c}")))
            # MAX_CATEGORIES rows at most (checked above)
            base = base.join(F.broadcast(d), F.get(F.col(fs), c) == F.col(f"_v{c}"), "left").drop(f"_v{c}")
            idx_cols[c] = F.col(f"_i{c}")
    sizes = {c: index.size(c) for c in layout.categorical}
    pieces, numeric = [], []
    for i in range(layout.width):
        if i == layout.label_pos:
            continue
        if i in sizes:
            pieces.append(one_hot(idx_cols[i], sizes[i]))
        else:
            numeric.append(_finite(F.col(f"_n{i}")))
            pieces.append(F.array(numeric[-1]))
    unseen = F.lit(False)
    for c in layout.categorical:
        unseen = unseen | (F.get(F.col(fs), c).isNotNull() & idx_cols[c].isNull())
    ok = (F.size(fs) == layout.width) & _all_present(numeric)
    return base.select(*keep, F.get(F.col(fs), layout.label_pos).alias("label"),
                       F.when(ok, F.concat(*pieces)).alias("features"),
                       unseen.alias("unseen"), ok.alias("ok"))
