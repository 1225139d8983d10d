"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the given tables (or data Spark derives from them) in
full. Floating outputs are rounded to 6 digits so that the SQL twin in
``oracle.py`` can be compared value by value. Model-dependent queries use
the given centres (``fixtures.given_centers``) so their results do not
depend on how a fit happened to be partitioned; the fitted-model queries
(streamed model state) are row-checked only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens import defaults as D
from clusterlens.functions.nearest import as_center_set, assign
from clusterlens.functions.vectors import distance
from clusterlens.operators import anomaly as an
from clusterlens.operators import encode as enc
from clusterlens.operators import evaluate as ev
from clusterlens.operators import kmeans as km
from clusterlens.operators import parse as ps
from clusterlens.operators import sample as sm
from clusterlens.operators import stats as st
from clusterlens.operators.ordering import positions
from clusterlens.operators.report import (caption, chart_label, chart_rows, cluster_report,
                                          group_members, group_small, hide_below, number_text,
                                          running_share, sort_rows, truncate_label, upsert,
                                          validate, with_share)
from clusterlens.operators.summary import anomaly_count_of
from clusterlens.plans import fixtures as fx
from clusterlens.plans import model_search as ms
from clusterlens.plans import train as tr
from clusterlens.plans.monitor import StreamMonitor
from clusterlens.schema import layout_schema
from clusterlens.session import path_exists, scratch_path, written
from clusterlens.sources import records as rec
from clusterlens.sources.report_json import read_report_json, write_report_json
from clusterlens.streaming.delta_log import DeltaLog, StreamMoments, WindowScores, summed
from clusterlens.streaming.dictionary import StreamDictionary, widen
from clusterlens.streaming.kmeans_stream import StreamingKMeans
from clusterlens.streaming.score import anomalies, file_stream, predict, window_scores

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 6
LAYOUT = fx.RECORD_LAYOUT
BASIC_SWEEP_KS = (2, 5, 10)


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, DIGITS)


def centers_long(spark, cs) -> DataFrame:
    """``cluster, pos, value`` rows of a centre set."""
    return (cs.to_df(spark)
              .select("cluster", F.posexplode("center").alias("pos", "value"))
              .withColumn("value", r6("value")))


# ---------------------------------------------------------------- records

def _records(spark, sf_dir):
    return fx.record_lines(spark, sf_dir)


def _records_once(spark, sf_dir):
    """The record lines for queries that read them more than once: joined and
    formatted once, kept in the shared folder."""
    return written(_records(spark, sf_dir), "record-lines")


def _numeric_records(spark, sf_dir):
    """Parsed records; malformed ones keep null features, which every
    consumer skips (no filter is pushed back into the parse)."""
    return ps.parse_numeric(_records(spark, sf_dir), LAYOUT, keep=("rid",))


def _mixed_records(spark, sf_dir, keep=("rid",)):
    lines = _records_once(spark, sf_dir)
    return enc.parse_mixed(lines, LAYOUT, enc.fit_categories(lines, LAYOUT), keep=keep)


def _written_records(spark, sf_dir) -> str:
    """Write the record lines as a text file in the shared folder (S1 input)."""
    path = scratch_path(spark, "records")
    rec.write_lines(_records(spark, sf_dir).select("line"), path)
    return path


def q_scan_records(spark, sf_dir):
    path = _written_records(spark, sf_dir)
    return rec.scan_csv(spark, path, layout_schema(LAYOUT))


def q_record_count(spark, sf_dir):
    path = _written_records(spark, sf_dir)
    return rec.record_count(rec.scan_text(spark, path))


def q_parse_numeric(spark, sf_dir):
    p = ps.parse_numeric(_records(spark, sf_dir), LAYOUT, keep=("rid",))
    names = [LAYOUT.name(i) for i in LAYOUT.numeric]
    return p.select("rid", "label",
                    *[F.col("features")[j].alias(n) for j, n in enumerate(names)], "ok")


def q_quarantine_counts(spark, sf_dir):
    """P1 quarantine accounting: parsed + quarantined = total."""
    return ps.quarantine_counts(ps.parse_numeric(fx.spoiled_lines(spark, sf_dir), LAYOUT))


def q_quarantine_rows(spark, sf_dir):
    """Exactly the spoiled records are quarantined."""
    p = ps.parse_numeric(fx.spoiled_lines(spark, sf_dir), LAYOUT, keep=("rid", "kind"))
    return ps.quarantine(p).select("rid", "kind")


def q_category_index(spark, sf_dir):
    return enc.fit_categories(_records(spark, sf_dir), LAYOUT)


def q_one_hot(spark, sf_dir):
    lines = _records_once(spark, sf_dir)
    index = enc.CategoryIndex.from_df(enc.fit_categories(lines, LAYOUT))
    prio = 3
    idx = enc.category_index(index, prio, F.get(ps.split_fields("line"), prio))
    # looked up in a step before the block, which uses it for every slot
    looked_up = lines.select("rid", idx.alias("idx"))
    block = enc.one_hot(F.col("idx"), index.size(prio))
    return looked_up.select("rid", F.posexplode(block).alias("pos", "value"))


def q_parse_mixed(spark, sf_dir):
    # malformed records (null features) go after the generator: a filter before it
    # is pushed into the parse, which then runs anew for every field
    p = _mixed_records(spark, sf_dir).select(
        "rid", "label", F.posexplode_outer("features").alias("pos", "value"))
    return p.where(F.col("pos").isNotNull())


def q_label_counts(spark, sf_dir):
    lines = _records(spark, sf_dir).select(ps.extract_label("line").alias("label"))
    return st.label_counts(lines)


def q_label_clean(spark, sf_dir):
    lines = _records(spark, sf_dir).select(ps.extract_label("line").alias("label"))
    return st.label_counts(lines).select(
        "label", ps.clean_label("label").alias("clean_label"),
        ps.display_label("label").alias("display_label"), "count")


def q_feature_moments(spark, sf_dir):
    m = st.feature_moments(_numeric_records(spark, sf_dir), dim=len(LAYOUT.numeric))
    return m.select("pos", "n", r6("mean").alias("mean"), r6("std").alias("std"))


def q_hash_split(spark, sf_dir):
    return _records(spark, sf_dir).select(
        "rid", sm.split_index("rid", (0.01, 0.99), seed=11).alias("part"))


def q_bootstrap_sample(spark, sf_dir):
    s = sm.bootstrap_sample(_numeric_records(spark, sf_dir), 0.01, seed=11, id_col="rid")
    return s.select("rid", "label", F.get("features", F.lit(0)).alias("l_quantity"))


def q_hash_split_fine(spark, sf_dir):
    """M1 with a part of 0.00004 of the records."""
    lines = _records(spark, sf_dir).withColumn("label", ps.extract_label("line"))
    return sm.hash_split(lines, (0.00004, 0.99996), 11, "rid")[0].select("rid", "label")


def q_split_repeated_lines(spark, sf_dir):
    """S1 + M1 on lines of which one is 57 % of all: how many copies of each line
    fall into a 1 % part and into the rest."""
    lines = fx.repeated_lines(spark, sf_dir)
    numbered = rec.numbered_records(lines).withColumn("part", sm.split_index("rid", (0.01, 0.99), seed=11))
    return (numbered.groupBy("line", "part").agg(F.count(F.lit(1)).alias("copies")))


def q_bootstrap_repeated_lines(spark, sf_dir):
    """S1 + M2 on the same lines: how often each line is drawn."""
    numbered = rec.numbered_records(fx.repeated_lines(spark, sf_dir))
    return (sm.bootstrap_sample(numbered, 0.01, seed=11, id_col="rid")
            .groupBy("line").agg(F.count(F.lit(1)).alias("drawn")))


def q_kmeans_default(spark, sf_dir):
    pts = fx.embedding_points(spark, sf_dir)
    return centers_long(spark, km.fit(pts, k=2, seed=1, id_col="id").centers)


def q_kmeans_tuned(spark, sf_dir):
    pts = fx.embedding_points(spark, sf_dir)
    return centers_long(spark, km.fit_best(pts, k=10, runs=10, tol=1e-6, seed=1, id_col="id").centers)


def _sweep(search, **options):
    """A sweep of the record lines; without options every k and run of the reference."""
    def query(spark, sf_dir):
        out = search(_records_once(spark, sf_dir), LAYOUT, id_col="rid", **options)
        return out.select("k", r6("score").alias("score"))
    return query


q_k_sweep_basic = _sweep(ms.search_k_basic, ks=BASIC_SWEEP_KS)
q_k_sweep_raw = _sweep(ms.search_k_raw)
q_k_sweep_zscore = _sweep(ms.search_k_zscore)
q_k_sweep_mixed = _sweep(ms.search_k_mixed)
q_k_sweep_entropy = _sweep(ms.search_k_entropy)


def q_anomaly_selffit(spark, sf_dir):
    pts = ps.parse_numeric(_records_once(spark, sf_dir), LAYOUT, keep=("rid",))
    det = an.build_detector_selffit(pts, k=20, runs=3, n=100, seed=1, id_col="rid")
    return det.anomalies(pts).select("rid", "label", "cluster", r6("dist").alias("dist"))


def q_anomaly_mixed(spark, sf_dir):
    """Original line, its label and distance for every anomalous record."""
    out = ms.list_anomalies(_records_once(spark, sf_dir), LAYOUT, k=20, runs=3, n=100, seed=1, id_col="rid")
    return out.select("line", "label", r6("dist").alias("dist"))


# ------------------------------------------------------------- embeddings

def assigned_embeddings(spark: SparkSession, sf_dir: str, method: str = "arrow") -> DataFrame:
    """Embeddings assigned to the given centres (id, label, cluster, dist)."""
    pts = fx.embedding_points(spark, sf_dir)
    return assign(pts, fx.given_centers(spark, sf_dir), method=method)


def q_label_makeup(spark, sf_dir):
    return ev.label_makeup(assigned_embeddings(spark, sf_dir))


def q_makeup_text(spark, sf_dir):
    return ev.makeup_text(ev.label_makeup(assigned_embeddings(spark, sf_dir)))


def q_assign_clusters(spark, sf_dir):
    a = assigned_embeddings(spark, sf_dir)
    return a.select("id", "label", "cluster", r6("dist").alias("dist"))


def q_assign_many_centers(spark, sf_dir):
    """X2 with several hundred centres: order lines to the mean line of every
    quantity and discount, through balls of centres."""
    cs = as_center_set(fx.grid_centers(spark, sf_dir))
    a = assign(fx.order_points(spark, sf_dir), cs, method="balls")
    return a.select("rid", "cluster", r6("dist").alias("dist"))


def q_vector_distance(spark, sf_dir):
    e = fx.embedding_points(spark, sf_dir)
    nxt = e.select((F.col("id") - 1).alias("id"), F.col("id").alias("next_id"),
                   F.col("features").alias("g"))
    return (e.join(nxt, "id").select("id", "next_id",
                                     r6(distance("features", "g")).alias("dist")))


def q_distance_score(spark, sf_dir):
    s = ev.distance_score(assigned_embeddings(spark, sf_dir))
    return s.select("n", r6("distance_score").alias("distance_score"))


def q_cluster_distance(spark, sf_dir):
    """A3 per cluster: size and mean distance to the cluster's centre."""
    d = ev.distance_by_cluster(assigned_embeddings(spark, sf_dir))
    return d.select("cluster", "n", r6("mean_dist").alias("mean_dist"))


def q_cluster_entropy(spark, sf_dir):
    e = ev.cluster_entropy(ev.label_makeup(assigned_embeddings(spark, sf_dir)))
    return e.select("cluster", "n", r6("entropy").alias("entropy"))


def q_entropy_score(spark, sf_dir):
    e = ev.entropy_score(ev.label_makeup(assigned_embeddings(spark, sf_dir)))
    return e.select("n", r6("entropy_score").alias("entropy_score"))


def q_distance_threshold(spark, sf_dir):
    t = an.distance_threshold(assigned_embeddings(spark, sf_dir), n=100)
    return t.select(r6("threshold").alias("threshold"))


def q_anomaly_count(spark, sf_dir):
    return anomaly_count_of(assigned_embeddings(spark, sf_dir), 100)


def q_anomaly_records(spark, sf_dir):
    """N1 + F1: z-scored embeddings, one centre per label in the z-scored
    space, threshold = 100th largest distance, records strictly beyond it."""
    pts = fx.embedding_points(spark, sf_dir)
    nz = st.Normalizer.fit(pts, dim=fx.EMBEDDING_DIM)
    centers = km.group_means(nz.apply(pts), "label", dim=fx.EMBEDDING_DIM)
    det = an.AnomalyDetector.build(pts, centers, nz, n=100)
    return det.anomalies(pts).select("id", "label", "cluster", r6("dist").alias("dist"))


def q_cluster_report(spark, sf_dir):
    rep = cluster_report(assigned_embeddings(spark, sf_dir), n=100)
    return rep.select("cluster", "label", "count", r6("entropy").alias("entropy"),
                      r6("mean_dist").alias("mean_dist"), "anomalies")


def q_lloyd_steps(spark, sf_dir):
    pts = fx.embedding_points(spark, sf_dir).persist()
    try:
        cs = km.lloyd(pts, fx.given_centers(spark, sf_dir), steps=2)
    finally:
        pts.unpersist()
    return centers_long(spark, cs)


def q_parse_tab_labelled(spark, sf_dir):
    p = ps.parse_tab_labelled(fx.embedding_lines(spark, sf_dir), keep=("id",))
    return p.select("id", "label", F.posexplode("features").alias("pos", "value"))


def q_parse_unlabelled(spark, sf_dir):
    p = ps.parse_unlabelled(fx.embedding_lines(spark, sf_dir), line_col="plain", keep=("id",))
    return p.select("id", F.posexplode("features").alias("pos", "value"))


# ----------------------------------------------------------------- events

def q_zscore_events(spark, sf_dir):
    z = st.zscore(fx.event_points(spark, sf_dir))
    return z.select(F.col("id").alias("event_id"), r6(F.col("features")[0]).alias("z_value"),
                    r6(F.col("features")[1]).alias("z_k"))


# ----------------------------------------------------- events model

def event_model(spark, sf_dir):
    """z-scored events and one centre per event type (the type's mean)."""
    pts = fx.event_points(spark, sf_dir)
    nz = st.Normalizer.fit(pts)
    z = nz.apply(pts)
    means = z.groupBy("label").agg(F.avg(F.col("features")[0]).alias("c0"),
                                   F.avg(F.col("features")[1]).alias("c1"))
    centers = positions(means, [F.col("label").asc()], "cluster").select(
        "cluster", F.array("c0", "c1").alias("center"))
    return z, centers


def q_window_score(spark, sf_dir):
    """R5 (batch form): hourly event-time windows, count and mean distance."""
    z, centers = event_model(spark, sf_dir)
    w = window_scores(assign(z, centers), time_col="ts", duration="1 hour")
    return w.select("window_start", "n", r6("mean_dist").alias("mean_dist"))


def _in_batches(spark, rows: DataFrame, part, start, batches: int = 4) -> None:
    """``rows`` as a stream of micro-batches: each part is a folder, in as many
    files as Spark makes, and taken up by a run of the same query.

    ``start(stream, checkpoint)`` starts the query on what is there and returns it.
    """
    src, checkpoint = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-ckpt")
    _folders(spark, rows, part, src, batches)
    for i in range(batches):
        start(_part_stream(spark, src, i, rows.schema), checkpoint).awaitTermination()


def _part_stream(spark, src: str, i: int, schema) -> DataFrame:
    """The files of one folder. A pattern: a run of the same query also looks up the
    files of the run before it, which would not lie under a plain path."""
    return file_stream(spark, f"{src}/_part={{{i}}}", schema)


def _folders(spark, rows: DataFrame, part, src: str, batches: int) -> list[str]:
    """Folders of the rows whose ``part`` is 0, 1, ..., written in one pass."""
    (rows.withColumn("_part", part.cast("int")).where(F.col("_part").between(0, batches - 1))
     .write.partitionBy("_part").parquet(src))
    folders = [f"{src}/_part={i}" for i in range(batches)]
    for folder in folders:
        if not path_exists(spark, folder):      # a batch without rows is a batch
            spark.createDataFrame([], rows.schema).write.parquet(folder)
    return folders


def _appended(spark, rows: DataFrame, part, transform) -> DataFrame:
    """The output of a stateless stream over ``rows``, written as it comes."""
    out = scratch_path(spark, "stream-out")

    def start(stream, checkpoint):
        return (transform(stream).writeStream.format("parquet").outputMode("append")
                .option("path", out).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
    _in_batches(spark, rows, part, start)
    return spark.read.parquet(out)


def _each(process):
    """A query that hands its micro-batches to ``process``."""
    def start(stream, checkpoint):
        return (stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
    return start


def _quarters(id_col: str, seed: int = 7):
    return sm.split_index(id_col, (1, 1, 1, 1), seed=seed)


def q_stream_anomalies(spark, sf_dir):
    """Events streamed in four batches; those beyond the frozen detector's threshold."""
    z, centers = event_model(spark, sf_dir)
    det = an.AnomalyDetector.build(z, centers, None, n=100)
    out = _appended(spark, z, _quarters("id"), lambda s: anomalies(s, det))
    return out.select(F.col("id").alias("event_id"), "label", "cluster", r6("dist").alias("dist"))


def q_stream_predict(spark, sf_dir):
    """Tab-labelled lines streamed in four batches -> nearest given centre."""
    centers = as_center_set(fx.given_centers(spark, sf_dir))

    def transform(stream):
        return predict(ps.valid(ps.parse_tab_labelled(stream, keep=("id",))), centers)
    out = _appended(spark, fx.embedding_lines(spark, sf_dir).select("id", "line"), _quarters("id"), transform)
    return out.select("id", "label", "cluster", r6("dist").alias("dist"))


def q_stream_window_score(spark, sf_dir):
    """Events arriving by the quarter of their time, one in twenty a batch
    late; scores of the windows, late records counted through the watermark."""
    z, centers = event_model(spark, sf_dir)
    cs = as_center_set(centers)
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    span = z.agg(F.min(seconds).alias("lo"), F.max(seconds).alias("hi")).first()
    quarter = F.least(F.lit(3), F.floor(F.lit(4) * (seconds - span["lo"]) / F.lit(max(span["hi"] - span["lo"], 1))))
    behind = (sm.split_index("id", (1, 19), seed=7) == 0).cast("int")
    scores = WindowScores(spark, scratch_path(spark, "windows"), z.schema["ts"].dataType.simpleString(), every=2)
    _in_batches(spark, z, quarter + behind,
                _each(lambda b, i: scores.process(assign(b, cs), i)), batches=5)
    return scores.scores().select("window_start", "n", r6("mean_dist").alias("mean_dist"), "late", "closed")


def q_stream_report(spark, sf_dir):
    """R6 + D8: the running make-up of a stream of points, kept as a delta log
    and compacted on the way."""
    cs = as_center_set(fx.given_centers(spark, sf_dir))
    log = DeltaLog(spark, scratch_path(spark, "running"), "cluster int, label int, count long",
                   summed(("cluster", "label")), every=3)
    _in_batches(spark, fx.embedding_points(spark, sf_dir), _quarters("id"),
                _each(lambda b, i: log.append(ev.label_makeup(assign(b, cs)), i)))
    return log.state()


def q_stream_moments(spark, sf_dir):
    """A2 on a stream: moments of the embeddings, merged over four batches."""
    moments = StreamMoments(spark, scratch_path(spark, "moments"), dim=fx.EMBEDDING_DIM, every=3)
    _in_batches(spark, fx.embedding_points(spark, sf_dir), _quarters("id"), _each(moments.process))
    return moments.moments().select("pos", "n", r6("mean").alias("mean"), r6("std").alias("std"))


def q_stream_dictionary(spark, sf_dir):
    """P2 + P4 on a stream: record lines arriving by order priority; each batch is
    encoded by the dictionary known then, its vectors are widened at the end.
    Returns the final entries with the number of vectors that have each."""
    grown = StreamDictionary(spark, scratch_path(spark, "dictionary"), LAYOUT, every=3)
    out = scratch_path(spark, "encoded")

    def process(batch, i):
        grown.process(batch, i)
        grown.encode(batch, i + 1, keep=("rid",)).write.mode("overwrite").parquet(f"{out}/{i}")
    part = (F.ascii(F.get(ps.split_fields("line"), 3)) * 3) % 4
    _in_batches(spark, fx.record_lines(spark, sf_dir), part, _each(process))
    sizes, first = grown.sizes(), F.lit(0)
    ones = None
    for i in grown.log.versions():                          # the four batches
        vectors = spark.read.parquet(f"{out}/{i}").select(
            widen("features", LAYOUT, grown.sizes(i + 1), sizes).alias("features"))
        ones = vectors if ones is None else ones.union(vectors)
    n = (ones.select(F.posexplode("features").alias("pos", "v")).groupBy("pos")
         .agg(F.sum("v").cast("long").alias("n")))
    at = 0
    for i in range(LAYOUT.width - 1):                       # the label is last
        if i in LAYOUT.categorical:
            first = F.when(F.col("field") == i, at).otherwise(first)
        at += sizes.get(i, 0) if i in LAYOUT.categorical else 1
    entries = grown.dictionary().withColumn("pos", first + F.col("idx"))
    return entries.join(n, "pos").select("field", "value", "idx", "n")


def _run_stream_kmeans(spark, sf_dir):
    """Streaming k-means over the embeddings arriving in four batches."""
    skm = StreamingKMeans(spark, scratch_path(spark, "stream-state"),
                          fx.given_centers(spark, sf_dir), initial_weight=100.0, decay=1.0)
    _in_batches(spark, fx.embedding_points(spark, sf_dir), _quarters("id"),
                lambda s, c: skm.start(s, c, {"availableNow": True}))
    return skm


def q_stream_kmeans(spark, sf_dir):
    skm = _run_stream_kmeans(spark, sf_dir)
    return (skm.centers().select("cluster", r6("weight").alias("weight"),
                                 F.posexplode("center").alias("pos", "value"))
            .withColumn("value", r6("value")))


def q_stream_distance(spark, sf_dir):
    skm = _run_stream_kmeans(spark, sf_dir)
    return skm.metrics().select("batch_id", "n", r6("distance_score").alias("distance_score"))


# ------------------------------------------------------------ report rows

def _makeup(spark, sf_dir):
    return ev.label_makeup(assigned_embeddings(spark, sf_dir))


def _chart(spark, sf_dir):
    return chart_rows(_makeup(spark, sf_dir))


def q_report_validate(spark, sf_dir):
    """F3 on the deviation of each (cluster, label) count from an even split
    of its cluster (zero or negative for under-represented labels)."""
    mk = _makeup(spark, sf_dir)
    per = mk.groupBy("cluster").agg(F.sum("count").alias("_t"), F.count(F.lit(1)).alias("_l"))
    rows = mk.join(per, "cluster").select(
        chart_label().alias("label"), (F.col("count") - F.col("_t") / F.col("_l")).alias("value"))
    return validate(rows).select("label", r6("value").alias("value"))


def q_makeup_sorted(spark, sf_dir):
    return ev.sorted_makeup(_makeup(spark, sf_dir))


def q_report_sort_none(spark, sf_dir):
    """T4 "none": the given order, here by count, survives."""
    from clusterlens.operators.report import sort_rows
    given = sort_rows(_chart(spark, sf_dir), "value-desc").withColumnRenamed("pos", "given")
    return sort_rows(given, "none", input_order="given").drop("given")


def _sorted(order):
    def q(spark, sf_dir):
        from clusterlens.operators.report import sort_rows
        return sort_rows(_chart(spark, sf_dir), order, seed=11)
    q.__name__ = f"q_report_sort_{order.replace('-', '_')}"
    return q


def q_report_share(spark, sf_dir):
    sh = hide_below(with_share(_chart(spark, sf_dir), decimals=D.PERCENT_DECIMALS),
                    D.HIDE_BELOW_PERCENT)
    return sh.select("label", "value", "total", "share",
                     r6("share_exact").alias("share_exact"), "hidden")


def q_report_group_small(spark, sf_dir):
    rows = sort_rows(_chart(spark, sf_dir), "value-asc")
    return group_small(rows, D.GROUP_SMALL_PERCENT, "percentage", label=D.GROUP_SMALL_LABEL)


def q_report_group_members(spark, sf_dir):
    """D3 members: the chart rows folded into the small-rows group."""
    rows = group_members(_chart(spark, sf_dir), D.GROUP_SMALL_PERCENT, "percentage",
                         label=D.GROUP_SMALL_LABEL)
    return rows.select("label", "value", "group")


def q_report_cumulative(spark, sf_dir):
    rows = running_share(sort_rows(_chart(spark, sf_dir), "value-desc"))
    return rows.select("label", "value", "pos", r6("end_share").alias("end_share"),
                       r6("mid_share").alias("mid_share"))


def q_report_captions(spark, sf_dir):
    sh = with_share(_chart(spark, sf_dir), decimals=D.PERCENT_DECIMALS)
    text = caption(D.CAPTION_TEMPLATE,
                   {"label": F.col("label"), "value": number_text("value"),
                    "percentage": F.col("share").cast("string")})
    return sh.select("label", truncate_label("label", D.TRUNCATE_LENGTH).alias("short_label"),
                     text.alias("caption"))


def q_report_upsert(spark, sf_dir):
    """Make-up of one half of the ids upserted (sum) with the other half."""
    a = assigned_embeddings(spark, sf_dir).withColumn(
        "_h", sm.split_index("id", (0.5, 0.5), seed=11))
    old = ev.label_makeup(a.where(F.col("_h") == 0))
    new = ev.label_makeup(a.where(F.col("_h") == 1))
    return upsert(old, new, ("cluster", "label"), "count", mode="sum")


def q_report_upsert_replace(spark, sf_dir):
    """D8, replace mode: keys present in the new half take its count."""
    a = assigned_embeddings(spark, sf_dir).withColumn(
        "_h", sm.split_index("id", (0.5, 0.5), seed=11))
    old = ev.label_makeup(a.where(F.col("_h") == 0))
    new = ev.label_makeup(a.where(F.col("_h") == 1))
    return upsert(old, new, ("cluster", "label"), "count", mode="replace")


def q_report_json(spark, sf_dir):
    """S4 then S5: write the make-up as a JSON report, read it back."""
    path = scratch_path(spark, "report-json")
    write_report_json(_makeup(spark, sf_dir), path)
    return read_report_json(spark, path)


# ------------------------------------------------ main flows

def _trained(lines):
    return tr.train(lines, LAYOUT, k=20, runs=3, tol=1e-6,
                    sample=0.05, seed=11, n_top=100, encoding="mixed")


def q_train_evaluate(spark, sf_dir):
    """Train on a 5 % hash sample, then its scores and threshold."""
    t = _trained(_records_once(spark, sf_dir))
    return spark.createDataFrame(
        [(t.n_train, t.model.k, round(t.distance_score, DIGITS), round(t.entropy_score, DIGITS),
          round(t.detector.threshold, DIGITS))],
        "n_train long, k int, distance_score double, entropy_score double, threshold double")


def q_stream_monitor(spark, sf_dir):
    """Record lines streamed in 4 micro-batches through the monitor; the
    anomalies it wrote (frozen detector) for all micro-batches. The lines are
    written once, by their part; training reads these folders too."""
    lines = _records(spark, sf_dir)
    src = scratch_path(spark, "monitor-src")
    folders = _folders(spark, lines, _quarters("rid", 5), src, 4)
    t = _trained(spark.read.schema(lines.schema).parquet(*folders))
    mon = StreamMonitor(spark, scratch_path(spark, "monitor"), t.parse, t.detector)
    checkpoint = scratch_path(spark, "monitor-ckpt")
    for i in range(4):
        mon.start(_part_stream(spark, src, i, lines.schema), checkpoint,
                  {"availableNow": True}).awaitTermination()
    return mon.anomalies().select("rid", "label", "cluster", r6("dist").alias("dist"))


QUERIES: dict[str, Query] = {
    # sources, parsing, encoding, sampling (records from lineitem x orders)
    "scan_records": q_scan_records,
    "record_count": q_record_count,
    "parse_numeric": q_parse_numeric,
    "quarantine_counts": q_quarantine_counts,
    "quarantine_rows": q_quarantine_rows,
    "category_index": q_category_index,
    "one_hot": q_one_hot,
    "parse_mixed": q_parse_mixed,
    "label_counts": q_label_counts,
    "label_clean": q_label_clean,
    "feature_moments": q_feature_moments,
    "hash_split": q_hash_split,
    "hash_split_fine": q_hash_split_fine,
    "bootstrap_sample": q_bootstrap_sample,
    "parse_tab_labelled": q_parse_tab_labelled,
    "parse_unlabelled": q_parse_unlabelled,
    "zscore_events": q_zscore_events,
    # nearest centre and scores (embeddings, given centres)
    "label_makeup": q_label_makeup,
    "makeup_text": q_makeup_text,
    "assign_clusters": q_assign_clusters,
    "assign_many_centers": q_assign_many_centers,
    "vector_distance": q_vector_distance,
    "distance_score": q_distance_score,
    "cluster_distance": q_cluster_distance,
    "cluster_entropy": q_cluster_entropy,
    "entropy_score": q_entropy_score,
    "distance_threshold": q_distance_threshold,
    "anomaly_count": q_anomaly_count,
    "anomaly_records": q_anomaly_records,
    "cluster_report": q_cluster_report,
    "lloyd_steps": q_lloyd_steps,
    "split_repeated_lines": q_split_repeated_lines,
    "bootstrap_repeated_lines": q_bootstrap_repeated_lines,
    # fitted models
    "kmeans_default": q_kmeans_default,
    "kmeans_tuned": q_kmeans_tuned,
    "k_sweep_basic": q_k_sweep_basic,
    "k_sweep_raw": q_k_sweep_raw,
    "k_sweep_zscore": q_k_sweep_zscore,
    "k_sweep_mixed": q_k_sweep_mixed,
    "k_sweep_entropy": q_k_sweep_entropy,
    "anomaly_selffit": q_anomaly_selffit,
    "anomaly_mixed": q_anomaly_mixed,
    # streaming
    "window_score": q_window_score,
    "stream_anomalies": q_stream_anomalies,
    "stream_predict": q_stream_predict,
    "stream_window_score": q_stream_window_score,
    "stream_report": q_stream_report,
    "stream_moments": q_stream_moments,
    "stream_dictionary": q_stream_dictionary,
    "stream_kmeans": q_stream_kmeans,
    "stream_distance": q_stream_distance,
    # report preparation
    "report_validate": q_report_validate,
    "report_sort_value_asc": _sorted("value-asc"),
    "report_sort_value_desc": _sorted("value-desc"),
    "report_sort_label_asc": _sorted("label-asc"),
    "report_sort_label_desc": _sorted("label-desc"),
    "report_sort_random": _sorted("random"),
    "report_sort_none": q_report_sort_none,
    "makeup_sorted": q_makeup_sorted,
    "report_share": q_report_share,
    "report_group_small": q_report_group_small,
    "report_group_members": q_report_group_members,
    "report_cumulative": q_report_cumulative,
    "report_captions": q_report_captions,
    "report_upsert": q_report_upsert,
    "report_upsert_replace": q_report_upsert_replace,
    "report_json": q_report_json,
    # main flows
    "train_evaluate": q_train_evaluate,
    "stream_monitor": q_stream_monitor,
}

# Queries SQL cannot express (streamed model state); the driver checks their
# rows only and pytest checks them against brute force / MLlib.
ROW_CHECKED = frozenset({"stream_kmeans", "stream_distance", "stream_monitor"})
