"""Command line: the reference's two jobs on any Spark-readable paths.

    python -m clusterlens train --input /data/connections --out /shared/report \\
        [--model /shared/model] [--k 130 --runs 10 ...]
    python -m clusterlens monitor --model /shared/model --input-dir /incoming \\
        --state /shared/monitor [--trigger-seconds 10]

``train`` reads the record lines, trains on a hash sample (E1), scores every
record with the trained detector, writes the per-cluster report (cluster,
label, count, entropy, mean distance, anomalies) as JSON, optionally saves the
model, and prints the training scores as one JSON line. ``monitor`` loads a
saved model and runs the streaming flow (E2) over line files arriving in a
directory: streaming k-means update and score, anomalies and report snapshots
per micro-batch, all under ``--state``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import types as T

from clusterlens import defaults as D
from clusterlens.plans import train as tr
from clusterlens.plans.monitor import StreamMonitor
from clusterlens.schema import CONNECTION_LAYOUT, RecordLayout
from clusterlens.session import get_spark
from clusterlens.sources import records as rec
from clusterlens.streaming.score import file_stream


def _train(a) -> None:
    layout = RecordLayout(width=a.width,
                          categorical=tuple(int(x) for x in a.categorical.split(",") if x))
    spark = get_spark()
    read = rec.scan_text(spark, a.input)
    lines = rec.with_record_id(read)
    # the sample is one of records: equal lines are numbered, and taken one by one
    trained = tr.train(rec.numbered_records(read), layout, k=a.k, runs=a.runs, sample=a.sample, seed=a.seed,
                       n_top=a.top, encoding=a.encoding)
    tr.report_all(tr.score_all(lines, layout, trained)).write.mode("overwrite").json(a.out)
    if a.model:
        tr.save(spark, trained, a.model)
    print(json.dumps({"n_train": trained.n_train, "k": trained.model.k,
                      "distance_score": trained.distance_score,
                      "entropy_score": trained.entropy_score,
                      "threshold": trained.detector.threshold}))


def _monitor(a) -> None:
    spark = get_spark()
    trained = tr.load(spark, a.model)
    state = a.state.rstrip("/")
    schema = T.StructType([T.StructField("value", T.StringType())])
    stream = file_stream(spark, a.input_dir, schema, fmt="text", max_files_per_trigger=None)
    lines = stream.withColumnRenamed("value", "line")
    # ids are given per micro-batch (a batch DataFrame over a fixed set of
    # files, so a replayed batch gets the same ids)
    mon = StreamMonitor(spark, f"{state}/monitor",
                        lambda batch: trained.parse(rec.with_record_id(batch)),
                        trained.detector, decay=a.decay)
    trigger = {"availableNow": True} if a.once else {"processingTime": f"{a.trigger_seconds} seconds"}
    mon.start(lines, f"{state}/checkpoint", trigger).awaitTermination()


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="clusterlens")
    sub = ap.add_subparsers(dest="command", required=True)
    t = sub.add_parser("train", help="batch job: train, score all records, report")
    t.add_argument("--input", required=True, help="record lines (text files)")
    t.add_argument("--out", required=True, help="folder for the JSON report")
    t.add_argument("--model", help="folder to save the trained model in")
    t.add_argument("--width", type=int, default=CONNECTION_LAYOUT.width)
    t.add_argument("--categorical", default="1,2,3")
    t.add_argument("--encoding", choices=("numeric", "mixed"), default="numeric")
    t.add_argument("--k", type=int, default=D.BATCH_K)
    t.add_argument("--runs", type=int, default=D.BATCH_RUNS)
    t.add_argument("--sample", type=float, default=D.BATCH_SAMPLE)
    t.add_argument("--seed", type=int, default=D.SPLIT_SEED)
    t.add_argument("--top", type=int, default=D.ANOMALY_TOP_N)
    m = sub.add_parser("monitor", help="streaming job over a directory of line files")
    m.add_argument("--model", required=True, help="folder written by train --model")
    m.add_argument("--input-dir", required=True, help="directory new line files arrive in")
    m.add_argument("--state", required=True, help="shared folder for state and outputs")
    m.add_argument("--decay", type=float, default=D.STREAM_DECAY)
    m.add_argument("--trigger-seconds", type=int, default=D.STREAM_BATCH_SECONDS)
    m.add_argument("--once", action="store_true", help="process what is there, then stop")
    a = ap.parse_args(argv)
    (_train if a.command == "train" else _monitor)(a)


if __name__ == "__main__":
    main()
