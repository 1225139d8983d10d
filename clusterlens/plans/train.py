"""Batch train-and-evaluate flow (the reference's main job, E1), and
scoring of all records with the trained detector.

read -> hash split -> parse (numeric fields, or one-hot with dictionaries)
-> z-score -> tuned k-means -> distance score, entropy, make-up -> anomaly
threshold; then the detector scores every record and the per-cluster report
is built. Only O(k*d) values (moments, centres, threshold) reach the driver.
Each input that is read more than once is persisted once and released in
``finally``. ``save`` / ``load`` keep the model as small tables so a separate
streaming job can use it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from clusterlens import defaults as D
from clusterlens.functions.nearest import CenterSet, assign
from clusterlens.operators import encode as enc
from clusterlens.operators import evaluate as ev
from clusterlens.operators import parse as ps
from clusterlens.operators.anomaly import AnomalyDetector, distance_threshold
from clusterlens.operators.kmeans import KMeansResult, fit_best
from clusterlens.operators.report import report_from_flags
from clusterlens.operators.sample import split_index
from clusterlens.operators.stats import Normalizer
from clusterlens.schema import RecordLayout


@dataclass
class TrainResult:
    layout: RecordLayout
    dictionary: DataFrame | None  # one-hot dictionaries (mixed encoding only)
    normalizer: Normalizer
    model: KMeansResult
    detector: AnomalyDetector
    n_train: int
    distance_score: float
    entropy_score: float

    def parse(self, lines: DataFrame, id_col: str = "rid") -> DataFrame:
        """The training parser: numeric fields only, or with one-hot blocks."""
        return parse_records(lines, self.layout, self.dictionary, id_col)


def parse_records(lines: DataFrame, layout: RecordLayout, dictionary: DataFrame | None,
                  id_col: str = "rid") -> DataFrame:
    """Parse keeping the id and the original line: one-hot (mixed) when a
    dictionary is given, numeric fields only otherwise.

    Malformed records stay in the output with ``ok = false`` and null
    features (the quarantine, ``parse.quarantine``); scoring and the
    aggregates skip them without a filter being pushed into the parse.
    """
    if dictionary is None:
        return ps.parse_numeric(lines, layout, keep=(id_col, "line"))
    return enc.parse_mixed(lines, layout, dictionary, keep=(id_col, "line"))


def train(lines: DataFrame, layout: RecordLayout, k: int = D.BATCH_K, runs: int = D.BATCH_RUNS,
          tol: float = D.BATCH_EPSILON, sample: float = D.BATCH_SAMPLE,
          seed: int = D.SPLIT_SEED, n_top: int = D.ANOMALY_TOP_N,
          id_col: str = "rid", max_iter: int = 20, encoding: str = "numeric") -> TrainResult:
    """E1 on the ``sample`` share of the records (hash split on ``id_col``).

    ``encoding="numeric"`` drops the categorical fields (the main job);
    ``"mixed"`` one-hot encodes them with dictionaries fitted on all records
    (the offline anomaly listing).
    """
    if encoding not in ("numeric", "mixed"):
        raise ValueError("encoding must be 'numeric' or 'mixed'")
    dictionary = enc.fit_categories(lines, layout).persist() if encoding == "mixed" else None
    part = split_index(id_col, (sample, 1.0 - sample), seed)
    parsed = (parse_records(lines.where(part == 0), layout, dictionary, id_col)
              .select(id_col, "label", "features", "ok")
              # a small sample keeps the input's many partitions: gather it once
              .repartition(lines.sparkSession.sparkContext.defaultParallelism).persist())
    try:
        batch = ps.valid(parsed)
        nz = Normalizer.fit(batch)
        nbatch = nz.apply(batch).persist()
        try:
            model = fit_best(nbatch, k, runs=runs, tol=tol, seed=seed, max_iter=max_iter,
                             id_col=id_col)
            assigned = assign(nbatch, model.centers).persist()
            try:
                s = ev.distance_score(assigned).first()
                makeup = ev.label_makeup(assigned)
                e = ev.entropy_score(makeup).first()["entropy_score"]
                t = distance_threshold(assigned, n_top).first()["threshold"]
            finally:
                assigned.unpersist()
        finally:
            nbatch.unpersist()
    finally:
        parsed.unpersist()
    return TrainResult(layout, dictionary, nz, model, AnomalyDetector(nz, model.centers, t),
                       int(s["n"]), float(s["distance_score"]), float(e))


def score_all(lines: DataFrame, layout: RecordLayout, trained: TrainResult,
              id_col: str = "rid") -> DataFrame:
    """Every record scored by the trained detector: id, line, label,
    cluster, dist, anomalous (the threshold is the trained one)."""
    return trained.detector.score(trained.parse(lines, id_col))


def report_all(scored: DataFrame) -> DataFrame:
    """D1 over scored records, using the detector's own flag."""
    return report_from_flags(scored)


_META = ("width int, categorical array<int>, label_index int, sep string, names array<string>, "
         "threshold double, k int, cost double, seed int, n_train long, distance_score double, "
         "entropy_score double, mixed boolean")


def save(spark: SparkSession, trained: TrainResult, path: str) -> None:
    """Write the trained model as small tables under ``path`` (shared
    storage): ``centers``, ``moments``, ``dictionary`` (mixed encoding only)
    and a one-row ``meta``. A separate streaming job loads it with ``load``."""
    root = path.rstrip("/")
    trained.detector.centers.to_df(spark).write.mode("overwrite").parquet(f"{root}/centers")
    trained.normalizer.to_df(spark).write.mode("overwrite").parquet(f"{root}/moments")
    if trained.dictionary is not None:
        trained.dictionary.write.mode("overwrite").parquet(f"{root}/dictionary")
    lay, m = trained.layout, trained.model
    spark.createDataFrame(
        [(lay.width, list(lay.categorical), lay.label_index, lay.sep, list(lay.names),
          trained.detector.threshold, m.k, m.cost, m.seed, trained.n_train,
          trained.distance_score, trained.entropy_score, trained.dictionary is not None)], _META
    ).write.mode("overwrite").parquet(f"{root}/meta")


def load(spark: SparkSession, path: str) -> TrainResult:
    """Read a model written by ``save``."""
    root = path.rstrip("/")
    meta = spark.read.parquet(f"{root}/meta").first()
    layout = RecordLayout(width=meta["width"], categorical=tuple(meta["categorical"]),
                          label_index=meta["label_index"], sep=meta["sep"],
                          names=tuple(meta["names"] or ()))
    moments = spark.read.parquet(f"{root}/moments").orderBy("pos").collect()
    nz = Normalizer(tuple(r["mean"] for r in moments), tuple(r["std"] for r in moments),
                    int(moments[0]["n"]) if moments else 0)
    centers = CenterSet.from_df(spark.read.parquet(f"{root}/centers"))
    # a mixed model without its dictionary fails here, it would parse to another width
    dictionary = spark.read.parquet(f"{root}/dictionary") if meta["mixed"] else None
    model = KMeansResult(centers, meta["cost"], meta["k"], meta["seed"])
    return TrainResult(layout, dictionary, nz, model,
                       AnomalyDetector(nz, centers, meta["threshold"]), meta["n_train"],
                       meta["distance_score"], meta["entropy_score"])
