"""SQL twins of the registered queries, written for DuckDB over the given
tables (views ``embeddings``, ``events``, ``lineitem``, ``orders``, ...).

They are independent formulations (cross join + row_number for the nearest
centre, window sums for entropy, typed columns instead of parsed text, ...)
rather than translations of the Spark code. Floats are rounded to 6 digits
(``+ 0.0`` turns a negative zero into zero).
"""

from __future__ import annotations

from clusterlens import defaults as D
from clusterlens.operators.kmeans_runs import Run
from clusterlens.plans import oracle_kmeans as ok

# places (of 2^32) at which a Poisson count of mean 0.01 rises by one:
# 2^32 times its distribution function at 0, 1, 2, 3
BOOTSTRAP_BOUNDS = "[4252231657, 4294753974, 4294966586, 4294967294]"


def R(x: str) -> str:
    return f"(round({x}, 6) + 0.0)"


# ------------------------------------------------------------------ records
_J = """
j AS (SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rid,
             l_quantity, l_returnflag, l_linestatus, o_orderpriority,
             l_extendedprice, l_discount, l_tax, o_orderstatus || '.' AS label
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

# records of which four kinds are spoiled: too few fields, text, NaN, infinity
_SPOILED = _J + """,
s AS (SELECT rid, CAST(CAST('0x' || substr(md5('spoil:' || rid), 1, 8) AS BIGINT) % 100 AS INTEGER) AS kind FROM j)"""

_DICT = _J + """,
dct AS (SELECT field, value,
               CAST(row_number() OVER (PARTITION BY field ORDER BY value) - 1 AS INTEGER) AS idx
        FROM (SELECT DISTINCT 1 AS field, l_returnflag AS value FROM j
              UNION SELECT DISTINCT 2, l_linestatus FROM j
              UNION SELECT DISTINCT 3, o_orderpriority FROM j)),
sz AS (SELECT field, count(*) AS n FROM dct GROUP BY field)"""

# ---------------------------------------------------------------- embeddings
_EMB = """
pts AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
ctr AS (SELECT CAST(label AS INTEGER) AS cluster, list(v ORDER BY pos) AS c
        FROM (SELECT p.label, x.pos, avg(x.v) AS v
              FROM pts p, unnest(p.f) WITH ORDINALITY AS x(v, pos) GROUP BY p.label, x.pos)
        GROUP BY label)"""

_ASSIGNED = _EMB + """,
pairs AS (SELECT p.id, p.label, c.cluster, list_distance(p.f, c.c) AS dist,
                 row_number() OVER (PARTITION BY p.id
                                    ORDER BY list_distance(p.f, c.c), c.cluster) AS rn
          FROM pts p CROSS JOIN ctr c),
asg AS (SELECT id, label, cluster, dist FROM pairs WHERE rn = 1),
thr AS (SELECT min(dist) AS t FROM (SELECT dist FROM asg ORDER BY dist DESC LIMIT 100)),
mk AS (SELECT cluster, label, count(*) AS count FROM asg GROUP BY cluster, label),
ent AS (SELECT cluster, CAST(sum(count) AS BIGINT) AS n, sum(-(count / tot) * ln(count / tot)) AS entropy
        FROM (SELECT cluster, count, sum(count) OVER (PARTITION BY cluster) AS tot FROM mk)
        GROUP BY cluster)"""

# z-scored embeddings, one centre per label in the z-scored space
_ZEMB = """
raw AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
u AS (SELECT r.id, x.v, x.pos FROM raw r, unnest(r.f) WITH ORDINALITY AS x(v, pos)),
mom AS (SELECT pos, avg(v) AS mu, stddev_pop(v) AS sd FROM u GROUP BY pos),
z AS (SELECT u.id, list(CASE WHEN m.sd > 0 THEN (u.v - m.mu) / m.sd ELSE u.v - m.mu END
                        ORDER BY u.pos) AS f
      FROM u JOIN mom m USING (pos) GROUP BY u.id),
pts AS (SELECT raw.id, raw.label, z.f FROM raw JOIN z USING (id)),
ctr AS (SELECT CAST(label AS INTEGER) AS cluster, list(v ORDER BY pos) AS c
        FROM (SELECT p.label, x.pos, avg(x.v) AS v
              FROM pts p, unnest(p.f) WITH ORDINALITY AS x(v, pos) GROUP BY p.label, x.pos)
        GROUP BY label),
pairs AS (SELECT p.id, p.label, c.cluster, list_distance(p.f, c.c) AS dist,
                 row_number() OVER (PARTITION BY p.id
                                    ORDER BY list_distance(p.f, c.c), c.cluster) AS rn
          FROM pts p CROSS JOIN ctr c),
asg AS (SELECT id, label, cluster, dist FROM pairs WHERE rn = 1),
thr AS (SELECT min(dist) AS t FROM (SELECT dist FROM asg ORDER BY dist DESC LIMIT 100))"""


def lloyd_sql(steps: int) -> str:
    ctes = [_EMB.strip(),
            "pl AS (SELECT p.id, x.v, CAST(x.pos - 1 AS INTEGER) AS pos "
            "FROM pts p, unnest(p.f) WITH ORDINALITY AS x(v, pos))"]
    prev = "ctr"
    for s in range(steps):
        ctes.append(f"""a{s} AS (SELECT id, cluster FROM (
    SELECT p.id, c.cluster, row_number() OVER (PARTITION BY p.id
           ORDER BY list_distance(p.f, c.c), c.cluster) AS rn
    FROM pts p CROSS JOIN {prev} c) WHERE rn = 1)""")
        ctes.append(f"""m{s} AS (SELECT a.cluster, pl.pos, avg(pl.v) AS v
    FROM a{s} a JOIN pl USING (id) GROUP BY a.cluster, pl.pos)""")
        ctes.append(f"""c{s + 1} AS (SELECT cluster, list(v ORDER BY pos) AS c FROM m{s} GROUP BY cluster
    UNION ALL SELECT cluster, c FROM {prev} WHERE cluster NOT IN (SELECT cluster FROM a{s}))""")
        prev = f"c{s + 1}"
    return ("WITH " + ",\n".join(ctes) + f"""
SELECT cluster, CAST(x.pos - 1 AS INTEGER) AS pos, {R('x.v')} AS value
FROM {prev}, unnest({prev}.c) WITH ORDINALITY AS x(v, pos)""")


_COPIES = _J + """,
l AS (SELECT CASE WHEN CAST('0x' || substr(md5('copy:' || rid), 1, 8) AS BIGINT) % 100 < 57
                  THEN '1.0,N,O,3-MEDIUM,1000.0,0.0,0.0,O.'
                  ELSE concat_ws(',', l_quantity, l_returnflag, l_linestatus, o_orderpriority,
                                 l_extendedprice, l_discount, l_tax, label) END AS line FROM j),
h AS (SELECT line, CAST('0x' || substr(md5('11:' || md5(line) || ':' ||
             row_number() OVER (PARTITION BY line)), 1, 8) AS BIGINT) AS h FROM l)"""


def _runs(ks, runs: int) -> list[Run]:
    return [Run(k, 1 + i) for k in ks for i in range(runs)]


_EMB_PTS = "pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings)"
_NUM = "SELECT rid AS id, [l_quantity, l_extendedprice, l_discount, l_tax]::DOUBLE[] AS f FROM j"
_NUM_PTS = f"{_J.strip()},\npts AS ({_NUM})"
_NUM_Z = f"{_J.strip()},\nraw AS ({_NUM}),\n{ok.ZSCORED}"
# one-hot: a 0/1 entry for each value of a field, values in order
_HOT = """[l_quantity]
       || list_transform((SELECT list(value ORDER BY value) FROM dct WHERE field = 1), lambda v: (v = l_returnflag)::DOUBLE)
       || list_transform((SELECT list(value ORDER BY value) FROM dct WHERE field = 2), lambda v: (v = l_linestatus)::DOUBLE)
       || list_transform((SELECT list(value ORDER BY value) FROM dct WHERE field = 3), lambda v: (v = o_orderpriority)::DOUBLE)
       || [l_extendedprice, l_discount, l_tax]"""
_MIX_Z = f"""{_DICT.strip()},
raw AS (SELECT rid AS id, {_HOT} AS f FROM j),
{ok.ZSCORED},
lab AS (SELECT rid AS id, label, concat_ws(',', l_quantity, l_returnflag, l_linestatus, o_orderpriority,
               l_extendedprice, l_discount, l_tax, label) AS line FROM j)"""
_SAMPLE_Z = _MIX_Z.replace("AS f FROM j)", """AS f FROM j
  WHERE CAST('0x' || substr(md5('11:' || rid), 1, 8) AS BIGINT) < 214748365)""", 1)

ORACLE: dict[str, str] = {
    # ------------------------------------------------------- repeated lines
    "split_repeated_lines": f"""WITH {_COPIES}
SELECT line, CASE WHEN h < 42949673 THEN 0 ELSE 1 END AS part, count(*) AS copies FROM h GROUP BY ALL""",
    "bootstrap_repeated_lines": f"""WITH {_COPIES}
SELECT line, CAST(sum(len(list_filter({BOOTSTRAP_BOUNDS}, lambda b: h >= b))) AS BIGINT) AS drawn
FROM h GROUP BY line HAVING drawn > 0""",
    # -------------------------------------------------------- fitted models
    "kmeans_default": ok.centers_sql(_EMB_PTS, _runs([2], 1), 2, 1e-4),
    "kmeans_tuned": ok.centers_sql(_EMB_PTS, _runs([10], 10), 5, 1e-6),
    "k_sweep_basic": ok.sweep_sql(_NUM_PTS, _runs((2, 5, 10), 1), 2, 1e-4),
    "k_sweep_raw": ok.sweep_sql(_NUM_PTS, _runs(D.SWEEP_RAW_KS, D.BATCH_RUNS), 5, 1e-6),
    "k_sweep_zscore": ok.sweep_sql(_NUM_Z, _runs(D.SWEEP_ZSCORE_KS, D.BATCH_RUNS), 5, 1e-6),
    "k_sweep_mixed": ok.sweep_sql(_MIX_Z, _runs(D.SWEEP_MIXED_KS, D.BATCH_RUNS), 5, 1e-6),
    "k_sweep_entropy": ok.entropy_sweep_sql(_MIX_Z, _runs(D.SWEEP_ENTROPY_KS, D.BATCH_RUNS), 5, 1e-6),
    "anomaly_selffit": ok.under_best(_NUM_Z, _runs([20], 3), 5, 1e-6) + f"""
SELECT rid, label, CAST(cluster AS INTEGER) AS cluster, {R('dist')} AS dist
FROM under JOIN j ON j.rid = under.id CROSS JOIN limit_ WHERE dist > t""",
    "anomaly_mixed": ok.under_best(_MIX_Z, _runs([20], 3), 5, 1e-6) + f"""
SELECT line, label, {R('dist')} AS dist FROM under JOIN lab USING (id) CROSS JOIN limit_ WHERE dist > t""",
    "train_evaluate": ok.under_best(_SAMPLE_Z, [Run(20, 11 + i) for i in range(3)], 5, 1e-6) + f""",
made AS (SELECT cluster, label, count(*) AS n FROM under JOIN lab USING (id) GROUP BY ALL),
share AS (SELECT n, n / sum(n) OVER (PARTITION BY cluster) AS p FROM made)
SELECT (SELECT count(*) FROM under) AS n_train, 20 AS k, (SELECT {R('avg(dist)')} FROM under) AS distance_score,
       (SELECT {R('sum(-n * ln(p)) / sum(n)')} FROM share) AS entropy_score, {R('t')} AS threshold FROM limit_""",
    # ------------------------------------------------------------ records
    "scan_records": f"""WITH {_J}
SELECT l_quantity, l_returnflag, l_linestatus, o_orderpriority,
       l_extendedprice, l_discount, l_tax, label FROM j""",
    "record_count": f"WITH {_J} SELECT count(*) AS n FROM j",
    "parse_numeric": f"""WITH {_J}
SELECT rid, label, l_quantity, l_extendedprice, l_discount, l_tax, true AS ok FROM j""",
    "category_index": f"WITH {_DICT} SELECT field, value, idx FROM dct",
    "one_hot": f"""WITH {_DICT}
SELECT j.rid, d.idx AS pos, CAST(d.value = j.o_orderpriority AS DOUBLE) AS value
FROM j JOIN dct d ON d.field = 3""",
    "parse_mixed": f"""WITH {_DICT},
o AS (SELECT (SELECT n FROM sz WHERE field = 1) AS n1,
             (SELECT n FROM sz WHERE field = 2) AS n2,
             (SELECT n FROM sz WHERE field = 3) AS n3)
SELECT rid, label, 0 AS pos, l_quantity AS value FROM j
UNION ALL SELECT j.rid, j.label, CAST(1 + d.idx AS INTEGER), CAST(d.value = j.l_returnflag AS DOUBLE)
  FROM j JOIN dct d ON d.field = 1
UNION ALL SELECT j.rid, j.label, CAST(1 + o.n1 + d.idx AS INTEGER), CAST(d.value = j.l_linestatus AS DOUBLE)
  FROM j JOIN dct d ON d.field = 2 CROSS JOIN o
UNION ALL SELECT j.rid, j.label, CAST(1 + o.n1 + o.n2 + d.idx AS INTEGER),
       CAST(d.value = j.o_orderpriority AS DOUBLE)
  FROM j JOIN dct d ON d.field = 3 CROSS JOIN o
UNION ALL SELECT rid, label, CAST(1 + n1 + n2 + n3 AS INTEGER), l_extendedprice FROM j, o
UNION ALL SELECT rid, label, CAST(2 + n1 + n2 + n3 AS INTEGER), l_discount FROM j, o
UNION ALL SELECT rid, label, CAST(3 + n1 + n2 + n3 AS INTEGER), l_tax FROM j, o""",
    "label_counts": f"WITH {_J} SELECT label, count(*) AS count FROM j GROUP BY label",
    "label_clean": f"""WITH {_J},
c AS (SELECT label, regexp_replace(label, '\\.$', '') AS clean_label, count(*) AS count
      FROM j GROUP BY label)
SELECT label, clean_label,
       upper(substr(clean_label, 1, 1)) || lower(substr(clean_label, 2)) AS display_label, count
FROM c""",
    "feature_moments": f"""WITH {_J},
u AS (SELECT 0 AS pos, l_quantity AS x FROM j UNION ALL SELECT 1, l_extendedprice FROM j
      UNION ALL SELECT 2, l_discount FROM j UNION ALL SELECT 3, l_tax FROM j)
SELECT pos, count(x) AS n, {R('avg(x)')} AS mean, {R('stddev_pop(x)')} AS std
FROM u GROUP BY pos""",
    "hash_split": f"""WITH {_J}
SELECT rid, CAST(CASE WHEN CAST('0x' || substr(md5('11:' || rid), 1, 8) AS BIGINT) < 42949673
                      THEN 0 ELSE 1 END AS INTEGER) AS part FROM j""",
    "hash_split_fine": f"""WITH {_J}
SELECT rid, label FROM j WHERE CAST('0x' || substr(md5('11:' || rid), 1, 8) AS BIGINT) < 171799""",
    "bootstrap_sample": f"""WITH {_J},
h AS (SELECT rid, label, l_quantity, CAST('0x' || substr(md5('11:' || rid), 1, 8) AS BIGINT) AS h FROM j)
SELECT rid, label, CAST(l_quantity AS DOUBLE) AS l_quantity
FROM h JOIN (SELECT unnest({BOOTSTRAP_BOUNDS}) AS b) ON h >= b""",
    "parse_tab_labelled": """
SELECT e.vec_id AS id, CAST(e.label AS DOUBLE) AS label, CAST(x.pos - 1 AS INTEGER) AS pos,
       CAST(x.v AS DOUBLE) AS value
FROM embeddings e, unnest(e.embedding) WITH ORDINALITY AS x(v, pos)""",
    "parse_unlabelled": """
SELECT e.vec_id AS id, CAST(x.pos - 1 AS INTEGER) AS pos, CAST(x.v AS DOUBLE) AS value
FROM embeddings e, unnest(e.embedding) WITH ORDINALITY AS x(v, pos)""",
    "zscore_events": f"""
WITH e AS (SELECT event_id, value AS x0,
                  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS x1 FROM events),
m AS (SELECT avg(x0) AS m0, stddev_pop(x0) AS s0, avg(x1) AS m1, stddev_pop(x1) AS s1 FROM e)
SELECT event_id,
       {R('CASE WHEN s0 > 0 THEN (x0 - m0) / s0 ELSE x0 - m0 END')} AS z_value,
       {R('CASE WHEN s1 > 0 THEN (x1 - m1) / s1 ELSE x1 - m1 END')} AS z_k
FROM e, m""",
    # --------------------------------------------------------- embeddings
    "label_makeup": f"WITH {_ASSIGNED} SELECT cluster, label, count FROM mk",
    "makeup_text": f"""WITH {_ASSIGNED}
SELECT cluster, label, count,
       printf('%1s%18s%8s', CAST(cluster AS VARCHAR), CAST(label AS VARCHAR),
              CAST(count AS VARCHAR)) AS line FROM mk""",
    "assign_clusters": f"WITH {_ASSIGNED} SELECT id, label, cluster, {R('dist')} AS dist FROM asg",
    "assign_many_centers": f"""WITH o AS (
  SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rid,
         CAST(round(l_quantity) AS INT) * 100 + CAST(round(l_discount * 100) AS INT) AS grid,
         CAST(l_quantity AS DOUBLE) AS a, l_discount * 100.0 AS b, l_tax * 100.0 AS c,
         l_extendedprice / 1000.0 AS d FROM lineitem),
ctr AS (SELECT grid AS cluster, avg(a) AS a, avg(b) AS b, avg(c) AS c, avg(d) AS d FROM o GROUP BY grid),
best AS (SELECT rid, min({{'s': (o.a - ctr.a) ** 2 + (o.b - ctr.b) ** 2 + (o.c - ctr.c) ** 2
                                + (o.d - ctr.d) ** 2, 'cluster': cluster}}) AS m
         FROM o CROSS JOIN ctr GROUP BY rid)
SELECT rid, m.cluster AS cluster, {R('sqrt(m.s)')} AS dist FROM best""",
    "vector_distance": f"""
SELECT a.vec_id AS id, b.vec_id AS next_id,
       {R('list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))')} AS dist
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
    "distance_score": f"""WITH {_ASSIGNED}
SELECT count(*) AS n, {R('avg(dist)')} AS distance_score FROM asg""",
    "cluster_entropy": f"WITH {_ASSIGNED} SELECT cluster, n, {R('entropy')} AS entropy FROM ent",
    "entropy_score": f"""WITH {_ASSIGNED}
SELECT CAST(sum(n) AS BIGINT) AS n, {R('sum(n * entropy) / sum(n)')} AS entropy_score FROM ent""",
    "distance_threshold": f"WITH {_ASSIGNED} SELECT {R('t')} AS threshold FROM thr",
    "anomaly_count": f"""WITH {_ASSIGNED}
SELECT count(*) FILTER (WHERE dist > t) AS anomalies FROM asg, thr""",
    "anomaly_records": f"""WITH {_ZEMB}
SELECT id, label, cluster, {R('dist')} AS dist FROM asg, thr WHERE dist > t""",
    "cluster_report": f"""WITH {_ASSIGNED},
pc AS (SELECT cluster, avg(dist) AS mean_dist,
              count(*) FILTER (WHERE dist > (SELECT t FROM thr)) AS anomalies
       FROM asg GROUP BY cluster)
SELECT mk.cluster, mk.label, mk.count, {R('ent.entropy')} AS entropy,
       {R('pc.mean_dist')} AS mean_dist, pc.anomalies
FROM mk JOIN ent USING (cluster) JOIN pc USING (cluster)""",
    "lloyd_steps": lloyd_sql(2),
}

# events: z-scored [value, k], one centre per event type (its mean)
_EVZ = """
e AS (SELECT event_id, event_type AS label, ts, value AS x0,
             CAST(json_extract_string(props, '$.k') AS DOUBLE) AS x1 FROM events),
m AS (SELECT avg(x0) AS m0, stddev_pop(x0) AS s0, avg(x1) AS m1, stddev_pop(x1) AS s1 FROM e),
z AS (SELECT event_id, label, ts,
             CASE WHEN s0 > 0 THEN (x0 - m0) / s0 ELSE x0 - m0 END AS z0,
             CASE WHEN s1 > 0 THEN (x1 - m1) / s1 ELSE x1 - m1 END AS z1 FROM e, m),
ctr AS (SELECT CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS cluster, c0, c1
        FROM (SELECT label, avg(z0) AS c0, avg(z1) AS c1 FROM z GROUP BY label)),
pairs AS (SELECT z.event_id, z.label, z.ts, c.cluster,
                 sqrt((z.z0 - c.c0) * (z.z0 - c.c0) + (z.z1 - c.c1) * (z.z1 - c.c1)) AS dist
          FROM z CROSS JOIN ctr c),
asg AS (SELECT event_id, label, ts, cluster, dist FROM (
          SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY dist, cluster) AS rn
          FROM pairs) WHERE rn = 1),
thr AS (SELECT min(dist) AS t FROM (SELECT dist FROM asg ORDER BY dist DESC LIMIT 100))"""

# chart rows: one per (cluster, label) of the given-centre make-up
_CHART = _ASSIGNED + """,
chart AS (SELECT 'cluster ' || CAST(cluster AS VARCHAR) || ' label ' || CAST(label AS VARCHAR) AS label,
                 CAST(count AS DOUBLE) AS value FROM mk),
tot AS (SELECT sum(value) AS total FROM chart)"""


def _sort_sql(order_by: str) -> str:
    return f"""WITH {_CHART}
SELECT label, value, CAST(row_number() OVER (ORDER BY {order_by}) - 1 AS BIGINT) AS pos
FROM chart"""


ORACLE_MORE: dict[str, str] = {
    "window_score": f"""WITH {_EVZ}
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n,
       {R('avg(dist)')} AS mean_dist
FROM asg GROUP BY 1""",
    "stream_anomalies": f"""WITH {_EVZ}
SELECT event_id, label, cluster, {R('dist')} AS dist FROM asg, thr WHERE dist > t""",
    "stream_predict": f"""WITH {_ASSIGNED}
SELECT id, CAST(label AS DOUBLE) AS label, cluster, {R('dist')} AS dist FROM asg""",
    "stream_window_score": f"""WITH {_EVZ},
span AS (SELECT min(epoch(date_trunc('second', ts))::BIGINT) AS lo, max(epoch(date_trunc('second', ts))::BIGINT) AS hi FROM asg),
arrived AS (
  SELECT asg.*, date_trunc('hour', ts) AS start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS finish,
         least(3, floor(4 * (epoch(date_trunc('second', ts))::BIGINT - lo) / greatest(hi - lo, 1)))
         + CASE WHEN CAST('0x' || substr(md5('7:' || event_id), 1, 8) AS BIGINT) < 214748365 THEN 1 ELSE 0 END AS b
  FROM asg, span),
marks AS (SELECT b, max(max(ts)) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                    - INTERVAL 1 HOUR AS mark FROM arrived GROUP BY b),
judged AS (SELECT a.*, coalesce(a.finish <= m.mark, false) AS late FROM arrived a JOIN marks m USING (b))
SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) FILTER (NOT late) AS n,
       {R('avg(dist) FILTER (NOT late)')} AS mean_dist, count(*) FILTER (late) AS late,
       any_value(finish) <= (SELECT max(ts) - INTERVAL 1 HOUR FROM asg) AS closed
FROM judged GROUP BY start""",
    "stream_report": f"WITH {_ASSIGNED} SELECT cluster, label, count FROM mk",
    "stream_moments": f"""WITH {_EMB},
u AS (SELECT CAST(x.pos - 1 AS INTEGER) AS pos, x.v FROM pts p, unnest(p.f) WITH ORDINALITY AS x(v, pos))
SELECT pos, count(v) AS n, {R('avg(v)')} AS mean, {R('stddev_pop(v)')} AS std FROM u GROUP BY pos""",
    "stream_dictionary": f"""WITH {_J},
v AS (SELECT 1 AS field, l_returnflag AS value, (ascii(o_orderpriority) * 3) % 4 AS part FROM j
      UNION ALL SELECT 2, l_linestatus, (ascii(o_orderpriority) * 3) % 4 FROM j
      UNION ALL SELECT 3, o_orderpriority, (ascii(o_orderpriority) * 3) % 4 FROM j)
SELECT field, value, count(*) AS n,
       CAST(row_number() OVER (PARTITION BY field ORDER BY min(part), value) - 1 AS INTEGER) AS idx
FROM v WHERE value IS NOT NULL GROUP BY field, value""",
    "report_validate": f"""WITH {_ASSIGNED},
v AS (SELECT 'cluster ' || CAST(cluster AS VARCHAR) || ' label ' || CAST(label AS VARCHAR) AS label,
             count - (sum(count) OVER (PARTITION BY cluster)) / (count(*) OVER (PARTITION BY cluster)) AS value
      FROM mk)
SELECT label, {R('value')} AS value FROM v WHERE value IS NOT NULL AND NOT isnan(value) AND value > 0""",
    "report_sort_random": _sort_sql("md5('11:' || label), label"),
    "report_sort_none": _sort_sql("value DESC, label"),
    "makeup_sorted": f"""WITH {_ASSIGNED}
SELECT cluster, label, count, CAST(row_number() OVER (ORDER BY cluster, label) - 1 AS BIGINT) AS pos FROM mk""",
    "report_sort_value_asc": _sort_sql("value, label"),
    "report_sort_value_desc": _sort_sql("value DESC, label"),
    "report_sort_label_asc": _sort_sql("lower(label), label"),
    "report_sort_label_desc": _sort_sql("lower(label) DESC, label DESC"),
    "report_share": f"""WITH {_CHART}
SELECT label, value, total, round(value / total * 100, 1) AS share,
       {R('value / total * 100')} AS share_exact, round(value / total * 100, 1) < 2 AS hidden
FROM chart, tot""",
    "report_group_small": f"""WITH {_CHART},
s AS (SELECT label, value, value / total * 100 <= 1 AS small FROM chart, tot),
kept AS (SELECT label, value, false AS is_grouped, CAST(0 AS BIGINT) AS members,
                row_number() OVER (ORDER BY value, label) AS o FROM s WHERE NOT small),
grp AS (SELECT 'Other clusters less than 1%' AS label, sum(value) AS value, true AS is_grouped,
               count(*) AS members, CAST(4611686018427387904 AS BIGINT) AS o
        FROM s WHERE small HAVING count(*) > 0),
u AS (SELECT * FROM kept UNION ALL SELECT * FROM grp)
SELECT label, value, is_grouped, members, CAST(row_number() OVER (ORDER BY o) - 1 AS BIGINT) AS pos
FROM u""",
    "report_cumulative": f"""WITH {_CHART},
o AS (SELECT label, value, CAST(row_number() OVER (ORDER BY value DESC, label) - 1 AS BIGINT) AS pos
      FROM chart)
SELECT label, value, pos,
       {R('sum(value) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / total * 100')}
         AS end_share,
       {R('sum(value) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / total * 100 - value / total * 50')}
         AS mid_share
FROM o, tot""",
    "report_captions": f"""WITH {_CHART}
SELECT label,
       CASE WHEN length(label) > 10 THEN substr(label, 1, 10) || '...' ELSE label END AS short_label,
       label || ', Count: ' ||
       (CASE WHEN value = floor(value) AND abs(value) < 1e15 THEN CAST(CAST(value AS BIGINT) AS VARCHAR)
             ELSE CAST(value AS VARCHAR) END) ||
       ', ' || CAST(round(value / total * 100, 1) AS VARCHAR) || '%' AS caption
FROM chart, tot""",
    "report_upsert": f"""WITH {_ASSIGNED},
h AS (SELECT *, CAST('0x' || substr(md5('11:' || CAST(id AS VARCHAR)), 1, 8) AS BIGINT) < 2147483648
                AS first_half FROM asg),
o AS (SELECT cluster, label, count(*) AS n FROM h WHERE first_half GROUP BY cluster, label),
n AS (SELECT cluster, label, count(*) AS n FROM h WHERE NOT first_half GROUP BY cluster, label)
SELECT coalesce(o.cluster, n.cluster) AS cluster, coalesce(o.label, n.label) AS label,
       coalesce(o.n, 0) + coalesce(n.n, 0) AS count
FROM o FULL OUTER JOIN n ON o.cluster = n.cluster AND o.label = n.label""",
    "report_json": f"""WITH {_ASSIGNED}
SELECT cluster, CAST(label AS VARCHAR) AS label, count AS value FROM mk""",
}
ORACLE.update(ORACLE_MORE)

ORACLE.update({
    "quarantine_counts": f"""WITH {_SPOILED}
SELECT count(*) FILTER (kind > 3) AS parsed, count(*) FILTER (kind <= 3) AS quarantined, count(*) AS total FROM s""",
    "quarantine_rows": f"""WITH {_SPOILED}
SELECT rid, kind FROM s WHERE kind <= 3""",
    "cluster_distance": f"""WITH {_ASSIGNED}
SELECT cluster, count(*) AS n, {R('avg(dist)')} AS mean_dist FROM asg GROUP BY cluster""",
    "report_group_members": f"""WITH {_CHART}
SELECT label, value, 'Other clusters less than 1%' AS "group"
FROM chart, tot WHERE value / total * 100 <= 1""",
})

ORACLE["report_upsert_replace"] = f"""WITH {_ASSIGNED},
h AS (SELECT *, CAST('0x' || substr(md5('11:' || CAST(id AS VARCHAR)), 1, 8) AS BIGINT) < 2147483648
                AS first_half FROM asg),
o AS (SELECT cluster, label, count(*) AS n FROM h WHERE first_half GROUP BY cluster, label),
n AS (SELECT cluster, label, count(*) AS n FROM h WHERE NOT first_half GROUP BY cluster, label)
SELECT coalesce(o.cluster, n.cluster) AS cluster, coalesce(o.label, n.label) AS label,
       coalesce(n.n, o.n) AS count
FROM o FULL OUTER JOIN n ON o.cluster = n.cluster AND o.label = n.label"""
