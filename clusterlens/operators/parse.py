"""Record parsing (P1, P5-P9) with a quarantine instead of job failure.

All parsing is built-in string/array expressions (``split``, ``try_cast``),
so it runs inside whole-stage code generation. Malformed rows (wrong width,
a non-numeric or non-finite value in a numeric field) are kept and marked ``ok = false``;
``valid`` + ``quarantine`` always add up to the input.
"""

from __future__ import annotations

import re
import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterlens.functions.vectors import col_of
from clusterlens.schema import RecordLayout


def split_fields(line: str | Column, sep: str = ",") -> Column:
    """All fields of a delimited line, trailing empty fields kept."""
    return F.split(col_of(line), re.escape(sep), -1)


def _num(c: Column) -> Column:
    """The number, or null: NaN and the infinities are no valid field either."""
    return _finite(c.try_cast("double"))


def _finite(v: Column) -> Column:
    return F.when(~F.isnan(v) & (F.abs(v) <= sys.float_info.max), v)


def _all_present(cols) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & c.isNotNull()
    return out


def parse_numeric(df: DataFrame, layout: RecordLayout, line_col: str = "line",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """``label`` + numeric ``features`` (categorical fields dropped).

    ``keep`` columns (e.g. an id, or the line itself, P7) are carried along.
    A malformed row has ``ok = false`` and null ``features``; every operator
    downstream skips null features, so hot paths need no filter here (a
    filter would be pushed below this projection and re-run the split).
    """
    fs = F.col("_fields")
    # the casts are a step of their own: what follows uses each several times
    parts = [_finite(F.col(f"_n{i}")) for i in layout.numeric]
    ok = (F.size(fs) == layout.width) & _all_present(parts)
    return (df.withColumn("_fields", split_fields(line_col, layout.sep))
              .withColumns({f"_n{i}": F.get(fs, i).try_cast("double") for i in layout.numeric})
              .select(*keep, F.get(fs, layout.label_pos).alias("label"),
                      F.when(ok, F.array(*parts)).alias("features"), ok.alias("ok")))


def valid(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("ok")).drop("ok")


def quarantine(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("ok")).drop("ok")


def quarantine_counts(parsed: DataFrame) -> DataFrame:
    """One row: parsed, quarantined, total (the two always add up)."""
    return parsed.agg(F.count(F.when(F.col("ok"), 1)).alias("parsed"),
                      F.count(F.when(~F.col("ok"), 1)).alias("quarantined"),
                      F.count(F.lit(1)).alias("total"))


def extract_label(line: str | Column, sep: str = ",") -> Column:
    """P5: the last field of a line."""
    return F.try_element_at(split_fields(line, sep), F.lit(-1))


def clean_label(label: str | Column) -> Column:
    """Drop one trailing ``.`` (``smurf.`` -> ``smurf``)."""
    return F.regexp_replace(col_of(label), r"\.$", "")


def display_label(label: str | Column) -> Column:
    """P6 for display: cleaned, first letter upper, rest lower (``Smurf``)."""
    c = clean_label(label)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def _has_width(width: int | None) -> Column:
    return F.lit(True) if width is None else F.size("_x") == width


def parse_tab_labelled(df: DataFrame, line_col: str = "line", sep: str = ",",
                       keep: tuple[str, ...] = (), width: int | None = None) -> DataFrame:
    """``label<TAB>f0,f1,...`` -> numeric ``label`` and ``features``;
    with ``width`` a record of another number of features is not ok."""
    parts = F.split(F.col(line_col), "\t", 2)
    out = df.select(*keep, _num(F.get(parts, 0)).alias("label"),
                    F.transform(split_fields(F.get(parts, 1), sep), _num).alias("_x"))
    ok = F.col("label").isNotNull() & F.col("_x").isNotNull() & \
        ~F.exists("_x", lambda x: x.isNull()) & _has_width(width)
    return out.select(*keep, "label", F.when(ok, F.col("_x")).alias("features"), ok.alias("ok"))


def parse_unlabelled(df: DataFrame, line_col: str = "line", sep: str = ",",
                     keep: tuple[str, ...] = (), width: int | None = None) -> DataFrame:
    """``f0,f1,...`` -> ``features``; ``width`` as in P8."""
    out = df.select(*keep, F.transform(split_fields(line_col, sep), _num).alias("_x"))
    ok = ~F.exists("_x", lambda x: x.isNull()) & _has_width(width)
    return out.select(*keep, F.when(ok, F.col("_x")).alias("features"), ok.alias("ok"))
