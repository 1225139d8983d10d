"""Print the final physical plans of the headline paths (the body of PLANS.md).

    python tools/capture_plans.py [/root/testdata/sf0.1] > plans.txt
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import numpy as np  # noqa: E402

from clusterlens.functions.nearest import CenterSet  # noqa: E402
from clusterlens.operators import encode as enc  # noqa: E402
from clusterlens.operators import stats as st  # noqa: E402
from clusterlens.operators.anomaly import AnomalyDetector  # noqa: E402
from clusterlens.plans import catalog, fixtures as fx  # noqa: E402
from clusterlens.plans import train as tr  # noqa: E402
from clusterlens.session import get_spark  # noqa: E402


def final_plan(df) -> str:
    df.collect()  # the adaptive plan is final after an action
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    out = []
    for line in buf.getvalue().splitlines():
        if "== Initial Plan ==" in line:
            break
        line = re.sub(r"#\d+L?", "", line)
        out.append(re.sub(r"\[plan_id=\d+\]", "", line)[:170])
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", shuffle_partitions=16)
    layout = fx.RECORD_LAYOUT
    lines = fx.record_lines(spark, sf)
    d = enc.fit_categories(lines, layout)
    parsed = tr.parse_records(lines, layout, d)
    nz = st.Normalizer.fit(parsed)
    cs = CenterSet.from_arrays(range(130), np.random.RandomState(0).randn(130, nz.dim))
    trained = tr.TrainResult(layout, d, nz, None, AnomalyDetector(nz, cs, 3.0), 0, 0.0, 0.0)
    items = [
        ("label_makeup (flagship: embeddings -> nearest label centre -> make-up)",
         catalog.QUERIES["label_makeup"](spark, sf)),
        ("E1 scoring of all records + cluster report (130 centres)",
         tr.report_all(tr.score_all(lines, layout, trained))),
        ("feature_moments (A2 over all parsed records)", catalog.QUERIES["feature_moments"](spark, sf)),
        ("window_score (R5 batch form)", catalog.QUERIES["window_score"](spark, sf)),
        ("distance_threshold (T1)", catalog.QUERIES["distance_threshold"](spark, sf)),
    ]
    for title, df in items:
        print(f"### {title}\n\n```\n{final_plan(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
