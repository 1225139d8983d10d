"""Report tables for the dashboard.

``cluster_report`` (D1) aggregates the assigned data once per
(cluster, label) with map-side combine; everything after it works on that
aggregated table. The chart steps that need one global order (sort
positions, the position of the folded group, running shares) use
``ordering.positions``: a distributed sort plus per-partition offsets, so no
step moves the whole table into one task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clusterlens import defaults as D
from clusterlens.functions.vectors import col_of
from clusterlens.operators.ordering import positions
from clusterlens.operators.summary import beyond, summarise, threshold_of
from clusterlens.session import written


# ------------------------------------------------------------------- D1

def cluster_report(assigned: DataFrame, n: int = 100, cluster_col: str = "cluster",
                   label_col: str = "label", dist_col: str = "dist") -> DataFrame:
    """``cluster, label, count, entropy, mean_dist, anomalies``.

    The records are read once, into a summary per (cluster, label) that is written
    to the shared folder; threshold and report are made from it.

    entropy: label entropy of the cluster (A5); mean_dist: the cluster's mean
    distance to its centre (A3 per cluster); anomalies: records of the
    cluster beyond the n-th largest distance overall (A7 per cluster).
    """
    groups = written(summarise(assigned, n, cluster_col, label_col, dist_col), "report-summary")
    marked = groups.withColumn("_t", threshold_of(groups, n).scalar())
    return _report(marked.select(cluster_col, label_col, "count", F.col("sum_dist").alias("_sd"),
                                 beyond(F.col("_t")).alias("_an")), cluster_col, label_col)


def report_from_flags(flagged: DataFrame, cluster_col: str = "cluster",
                      label_col: str = "label", dist_col: str = "dist",
                      flag_col: str = "anomalous") -> DataFrame:
    """D1 from records that already carry their anomaly flag.

    The records are read once: one map-side-combined aggregate per
    (cluster, label). The per-cluster figures come from a window over that
    aggregated table (at most #labels rows per cluster), not from a second
    pass over the records.
    """
    cl = (flagged.groupBy(cluster_col, label_col)
                 .agg(F.count(F.lit(1)).alias("count"),
                      F.sum(dist_col).alias("_sd"),
                      F.count(F.when(F.col(flag_col), 1)).alias("_an"))
                 .where(F.col(cluster_col).isNotNull()))
    return _report(cl, cluster_col, label_col)


def _report(cl: DataFrame, cluster_col: str, label_col: str) -> DataFrame:
    """The report rows from ``count, _sd, _an`` per (cluster, label)."""
    w = Window.partitionBy(cluster_col)
    c = F.col("count").cast("double")
    t = F.sum("count").over(w).cast("double")
    return cl.select(
        cluster_col, label_col, "count",
        F.when(F.max("count").over(w) == F.sum("count").over(w), 0.0).otherwise(
            F.greatest(F.log(t) - F.sum(c * F.log(c)).over(w) / t, F.lit(0.0))).alias("entropy"),
        (F.sum("_sd").over(w) / t).alias("mean_dist"),
        F.sum("_an").over(w).alias("anomalies"))


def chart_label(cluster: str | Column = "cluster", label: str | Column = "label") -> Column:
    """The chart's row label for a (cluster, label) pair."""
    return F.concat(F.lit("cluster "), col_of(cluster).cast("string"),
                    F.lit(" label "), col_of(label).cast("string"))


def chart_rows(makeup: DataFrame, cluster_col: str = "cluster",
               label_col: str = "label", count_col: str = "count") -> DataFrame:
    """Report rows as chart rows: ``label`` ("cluster C label L"), ``value``."""
    return makeup.select(chart_label(cluster_col, label_col).alias("label"),
                         F.col(count_col).cast("double").alias("value"))


# ------------------------------------------------------------------- F3

def validate(rows: DataFrame, value_col: str = "value") -> DataFrame:
    """keep rows whose value is a number, not NaN, and > 0."""
    v = F.col(value_col)
    return rows.where(v.isNotNull() & ~F.isnan(v) & (v > 0))


# ------------------------------------------------------------------- T4

# fixed values: the chart's order names
SORT_ORDERS = ("none", "random", "value-asc", "value-desc", "label-asc", "label-desc")


def sort_rows(rows: DataFrame, order: str = D.REPORT_SORT_ORDER, seed: int = 0,
              value_col: str = "value", label_col: str = "label",
              input_order: str | None = None) -> DataFrame:
    """T4: add ``pos`` (0-based) in the chart order.

    Ties are broken by the label (the chart's comparator left them to the
    sort implementation). ``random`` goes by the md5 of seed and label, the
    same on any partition layout. Labels compare case-insensitively. ``none`` keeps
    ``input_order`` (a column) when given.
    """
    v, lab = F.col(value_col), F.col(label_col)
    keys = {
        "value-asc": [v.asc(), lab.asc()],
        "value-desc": [v.desc(), lab.asc()],
        "label-asc": [F.lower(lab).asc(), lab.asc()],
        "label-desc": [F.lower(lab).desc(), lab.desc()],
        "random": [F.md5(F.concat(F.lit(f"{seed}:"), lab.cast("string"))), lab.asc()],
        "none": [F.col(input_order).asc()] if input_order else [F.monotonically_increasing_id()],
    }
    if order not in keys:
        raise ValueError(f"order must be one of {SORT_ORDERS}")
    return positions(rows, keys[order], "pos")


# ---------------------------------------------------------------- D2, D5

def with_share(rows: DataFrame, decimals: int = D.PERCENT_DECIMALS,
               value_col: str = "value") -> DataFrame:
    """``total``, ``share`` (percent, rounded half-up to ``decimals``)
    and ``share_exact`` (unrounded)."""
    total = rows.agg(F.sum(value_col)).scalar()
    exact = F.col(value_col) / total * 100.0
    return (rows.withColumn("total", total)
                .withColumn("share_exact", exact)
                .withColumn("share", F.round(exact, max(decimals, 0))))


def hide_below(shared: DataFrame, percent: float, out: str = "hidden") -> DataFrame:
    """Flag rows whose *rounded* share is below ``percent``."""
    return shared.withColumn(out, F.col("share") < F.lit(float(percent)))


# ------------------------------------------------------------------- D3

def _small(rows: DataFrame, threshold: float, mode: str, value_col: str) -> Column:
    v = F.col(value_col)
    if mode == "percentage":
        total = rows.agg(F.sum(value_col)).scalar()
        return v / total * 100.0 <= F.lit(float(threshold))
    if mode == "value":
        return v <= F.lit(float(threshold))
    raise ValueError("mode must be 'percentage' or 'value'")


def group_small(rows: DataFrame, threshold: float = D.GROUP_SMALL_PERCENT,
                mode: str = "percentage", label: str = D.GROUP_SMALL_LABEL,
                value_col: str = "value",
                label_col: str = "label") -> DataFrame:
    """D3: rows at or below the threshold become one ``label`` row, last.

    Output: ``label, value, is_grouped, members, pos``. Input rows must carry
    ``pos`` (see ``sort_rows``). The members themselves are listed by
    ``group_members`` (as rows, never collected into one value).
    """
    flagged = rows.withColumn("_small", _small(rows, threshold, mode, value_col))
    kept = flagged.where(~F.col("_small")).select(
        label_col, value_col, F.lit(False).alias("is_grouped"),
        F.lit(0).cast("long").alias("members"), F.col("pos").cast("long").alias("_o"))
    grouped = (flagged.where(F.col("_small"))
               .agg(F.sum(value_col).alias(value_col), F.count(F.lit(1)).alias("members"))
               .where(F.col("members") > 0)
               .select(F.lit(label).alias(label_col), value_col,
                       F.lit(True).alias("is_grouped"), "members",
                       F.lit(1 << 62).cast("long").alias("_o")))
    both = kept.unionByName(grouped)
    return positions(both, [F.col("_o").asc(), F.col(label_col).asc()], "pos").drop("_o")


def group_members(rows: DataFrame, threshold: float = D.GROUP_SMALL_PERCENT,
                  mode: str = "percentage", label: str = D.GROUP_SMALL_LABEL,
                  value_col: str = "value") -> DataFrame:
    """D3 members: the rows folded into the group, with the group label."""
    flagged = rows.withColumn("_small", _small(rows, threshold, mode, value_col))
    return flagged.where(F.col("_small")).drop("_small").withColumn("group", F.lit(label))


# ------------------------------------------------------------------- D4

def running_share(rows: DataFrame, value_col: str = "value") -> DataFrame:
    """``end_share`` (share up to and including the row, in order of
    ``pos``) and ``mid_share`` (minus half the row's own share), percent."""
    total = rows.agg(F.sum(value_col)).scalar()
    cum = positions(rows.withColumnRenamed("pos", "_p"), [F.col("_p").asc()], "_q",
                    value_col=value_col, cum_col="_cum")
    return (cum.withColumnRenamed("_p", "pos").drop("_q")
               .withColumn("end_share", F.col("_cum") / total * 100.0)
               .withColumn("mid_share", F.col("end_share") - F.col(value_col) / total * 50.0)
               .drop("_cum"))


# ---------------------------------------------------------------- D6, D7

def truncate_label(label: str | Column, n: int = D.TRUNCATE_LENGTH) -> Column:
    """First n characters + ``...`` when longer than n."""
    c = col_of(label)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def label_text(rows: DataFrame, formatter=None, truncate: int | None = D.TRUNCATE_LENGTH,
               label_col: str = "label", value_col: str = "value",
               out: str = "label_text") -> DataFrame:
    """The label the chart shows: ``formatter(label, value)`` when a hook is
    given (a Column -> Column function, it wins), else the truncated label."""
    lab, val = F.col(label_col), F.col(value_col)
    if formatter is not None:
        text = formatter(lab, val)
    elif truncate is not None:
        text = truncate_label(lab, truncate)
    else:
        text = lab
    return rows.withColumn(out, text)


def number_text(value: str | Column) -> Column:
    """A number as the chart prints it: integral values without ``.0``."""
    v = col_of(value)
    return F.when((v % 1 == 0) & (F.abs(v) < 1e21), v.cast("decimal(22,0)").cast("string")) \
        .otherwise(v.cast("string"))


# fixed value: the chart's placeholder syntax
_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def caption(template: str, fields: dict[str, Column], parser=None) -> Column:
    """Fill ``{name}`` placeholders from ``fields``; unknown names stay.

    ``parser`` is the placeholder hook: it receives the mapping and returns
    the mapping to use (it may replace or add Column expressions). The
    template is split once on the driver into literal text and column
    references, so the result is a single ``concat`` expression.
    """
    if parser is not None:
        fields = parser(dict(fields))
    parts: list[Column] = []
    last = 0
    for m in _PLACEHOLDER.finditer(template):
        if m.start() > last:
            parts.append(F.lit(template[last:m.start()]))
        name = m.group(1)
        parts.append(fields[name].cast("string") if name in fields else F.lit(m.group(0)))
        last = m.end()
    if last < len(template):
        parts.append(F.lit(template[last:]))
    return F.concat(*parts) if parts else F.lit("")


# ------------------------------------------------------------------- D8

def upsert(old: DataFrame, new: DataFrame, keys=("cluster", "label"),
           value_col: str = "count", mode: str = "replace") -> DataFrame:
    """Known keys take the new value (``replace``) or old + new
    (``sum``); new keys are added; keys only in ``old`` stay."""
    o = old.select(*keys, F.col(value_col).alias("_old"))
    n = new.select(*keys, F.col(value_col).alias("_new"))
    j = o.join(n, list(keys), "full_outer")
    if mode == "replace":
        v = F.coalesce(F.col("_new"), F.col("_old"))
    elif mode == "sum":
        v = F.coalesce(F.col("_old"), F.lit(0)) + F.coalesce(F.col("_new"), F.lit(0))
    else:
        raise ValueError("mode must be 'replace' or 'sum'")
    return j.select(*keys, v.alias(value_col))
