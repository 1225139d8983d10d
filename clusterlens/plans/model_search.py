"""Entry points over raw record lines: k sweeps (K3, K5-K8) and the offline
anomaly listing (N3, E3).

Each one parses, normalises where the flow calls for it, and returns a
DataFrame: ``(k, score)`` rows for sweeps, anomalous original records for
the listing. Defaults are the reference's k ranges and runs
(``clusterlens.defaults``); all runs of all k share their passes over one
persisted input. ``id_col`` names the rows for the fits' random draws.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from clusterlens import defaults as D
from clusterlens.operators import encode as enc
from clusterlens.operators import kmeans as km
from clusterlens.operators import parse as ps
from clusterlens.operators.anomaly import build_detector_selffit
from clusterlens.operators.stats import zscore
from clusterlens.schema import RecordLayout


def _keep(id_col: str | None) -> tuple[str, ...]:
    return (id_col,) if id_col else ()


def _numeric(lines: DataFrame, layout: RecordLayout, keep: tuple[str, ...] = ()) -> DataFrame:
    return ps.parse_numeric(lines, layout, keep=keep)


def _mixed(lines: DataFrame, layout: RecordLayout, keep: tuple[str, ...] = ()) -> DataFrame:
    return enc.parse_mixed(lines, layout, enc.fit_categories(lines, layout), keep=keep)


def search_k_basic(lines: DataFrame, layout: RecordLayout, ks=tuple(range(5, 31, 5)),
                   id_col: str | None = None) -> DataFrame:
    """K3 sweep: default fit per k on numeric features, mean distance."""
    return km.k_sweep(_numeric(lines, layout, _keep(id_col)), ks, tuned=False, id_col=id_col)


def search_k_raw(lines: DataFrame, layout: RecordLayout, ks=D.SWEEP_RAW_KS,
                 runs: int = D.BATCH_RUNS, id_col: str | None = None) -> DataFrame:
    """K5: tuned fit per k on raw numeric features, mean distance."""
    return km.k_sweep(_numeric(lines, layout, _keep(id_col)), ks, runs=runs, id_col=id_col)


def search_k_zscore(lines: DataFrame, layout: RecordLayout, ks=D.SWEEP_ZSCORE_KS,
                    runs: int = D.BATCH_RUNS, id_col: str | None = None) -> DataFrame:
    """K6: tuned fit per k on z-scored numeric features, mean distance."""
    return km.k_sweep(zscore(_numeric(lines, layout, _keep(id_col))), ks, runs=runs, id_col=id_col)


def search_k_mixed(lines: DataFrame, layout: RecordLayout, ks=D.SWEEP_MIXED_KS,
                   runs: int = D.BATCH_RUNS, id_col: str | None = None) -> DataFrame:
    """K7: tuned fit per k on z-scored one-hot features, mean distance."""
    return km.k_sweep(zscore(_mixed(lines, layout, _keep(id_col))), ks, runs=runs, id_col=id_col)


def search_k_entropy(lines: DataFrame, layout: RecordLayout, ks=D.SWEEP_ENTROPY_KS,
                     runs: int = D.BATCH_RUNS, id_col: str | None = None) -> DataFrame:
    """K8: tuned fit per k on z-scored one-hot features, weighted entropy."""
    return km.k_sweep(zscore(_mixed(lines, layout, _keep(id_col))), ks, how="entropy", runs=runs,
                      id_col=id_col)


def list_anomalies(lines: DataFrame, layout: RecordLayout, k: int = D.DETECTOR_K,
                   runs: int = D.BATCH_RUNS, n: int = D.ANOMALY_TOP_N,
                   seed: int = 1, id_col: str | None = None) -> DataFrame:
    """One-hot parse (original line kept), self-fitted detector, and
    the anomalous records: ``line, label, dist``. Count them with
    ``.count()``; labels are the ``label`` column."""
    # malformed records have null features, which every step below skips; a filter
    # here would be pushed into the parse and repeat it for every field
    pts = _mixed(lines, layout, keep=("line", *_keep(id_col)))
    det = build_detector_selffit(pts, k=k, runs=runs, n=n, seed=seed, id_col=id_col)
    return det.anomalies(pts).select("line", "label", "dist")
