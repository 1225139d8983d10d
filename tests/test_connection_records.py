"""The reference's own record shape: 42 comma-separated fields, protocol,
service and flag categorical at 1-3, the label last with a trailing dot."""

import numpy as np

from clusterlens.operators import encode as enc
from clusterlens.operators import parse as ps
from clusterlens.plans import train as tr
from clusterlens.schema import CONNECTION_LAYOUT, connection_schema
from clusterlens.session import scratch_path
from clusterlens.sources import records as rec


def connection_lines(n=300, seed=0):
    rng = np.random.RandomState(seed)
    protocols, services, flags = ["tcp", "udp", "icmp"], ["http", "smtp", "ftp", "private"], ["SF", "S0", "REJ"]
    labels = ["normal.", "smurf.", "neptune."]
    out = []
    for i in range(n):
        nums = [f"{v:g}" for v in rng.poisson(3, size=38) * (1 + (i % 3))]
        fields = [nums[0], protocols[i % 3], services[i % 4], flags[(i // 3) % 3]] + nums[1:] + [labels[i % 3]]
        out.append((f"r{i}", ",".join(fields)))
    return out


def test_connection_records_end_to_end(spark):
    rows = connection_lines()
    lines = spark.createDataFrame(rows, "rid string, line string")
    assert len(rows[0][1].split(",")) == 42

    num = ps.parse_numeric(lines, CONNECTION_LAYOUT, keep=("rid",))
    assert ps.quarantine_counts(num).first().quarantined == 0
    assert len(num.first().features) == 38

    d = enc.fit_categories(lines, CONNECTION_LAYOUT)
    sizes = enc.CategoryIndex.from_df(d).sizes
    assert sizes == {1: 3, 2: 4, 3: 3}
    mixed = enc.parse_mixed(lines, CONNECTION_LAYOUT, d, keep=("rid",)).orderBy("rid").first()
    f = mixed.features
    assert len(f) == 48
    # r0: protocol tcp (index 1 of icmp, tcp, udp), service http (index 1 of ftp, http, private, smtp),
    # flag SF (index 2 of REJ, S0, SF); blocks follow f0 in field order
    assert f[1:4] == [0.0, 1.0, 0.0] and f[4:8] == [0.0, 1.0, 0.0, 0.0] and f[8:11] == [0.0, 0.0, 1.0]
    assert mixed.label == "normal."

    trained = tr.train(lines, CONNECTION_LAYOUT, k=3, runs=1, sample=0.5, seed=11, n_top=10,
                       encoding="mixed")
    scored = tr.score_all(lines, CONNECTION_LAYOUT, trained)
    rep = tr.report_all(scored).collect()
    assert sum(r["count"] for r in rep) == 300
    assert {r.label for r in rep} == {"normal.", "smurf.", "neptune."}

    path = scratch_path(spark, "t-conn")
    rec.write_lines(lines, path)
    typed = rec.scan_csv(spark, path, connection_schema())
    first = typed.where("label = 'normal.'").first()
    assert first.protocol_type in ("tcp", "udp", "icmp") and isinstance(first.src_bytes, float)
    assert typed.count() == 300
