"""SQL twin of the k-means fits: seeding, reclustering and Lloyd steps unrolled
into one statement, with all runs side by side.

``fit_sql`` expects a CTE ``pts(id, f)`` and adds, for runs numbered from 0 in
the order given, ``fit(r, cluster, f)`` (the centres) and ``fitted(r, k, seed,
cost, mean_distance)``. It works with cross joins and window functions where the
Spark side works in passes; only the hash that draws the points is shared.
"""

from __future__ import annotations

from collections.abc import Sequence

from clusterlens.operators.kmeans_runs import LOCAL_STEPS, OVERSAMPLE, PRIME, Run, coefficients


def _draws(runs: Sequence[Run], rounds: int) -> str:
    rows = []
    for r, run in enumerate(runs):
        tags = ["first", *(f"round{i}" for i in range(rounds)), *(f"pick{j}" for j in range(run.k))]
        rows += [f"({r}, '{t}', {', '.join(f'{c}::BIGINT' for c in coefficients(run.seed, t))})" for t in tags]
    return ", ".join(rows)


_U = f"((((a1 * b1 + c1) % {PRIME}) + (((a2 * b2 + c2) % {PRIME}) + 0.5) / {PRIME}.0) / {PRIME}.0)"


def _lloyd(name: str, rows: str, start: str, steps: int, tol: str | None) -> tuple[list[str], str]:
    """Unrolled Lloyd steps of ``rows(r, pid, f, w)`` from ``start(r, cluster, f,
    done)``; with ``tol`` a run that moved no farther is done."""
    out, prev = [], start
    for s in range(steps):
        near, mean, new = f"{name}n{s}", f"{name}m{s}", f"{name}c{s}"
        out.append(f"""{near} AS MATERIALIZED (
  SELECT c.r, p.pid, any_value(p.f) AS f, any_value(p.w) AS w,
         arg_min(c.cluster, (list_distance(p.f, c.f), c.cluster)) AS cluster
  FROM {prev} c JOIN {rows} p ON {'p.r = c.r' if rows != 'points' else 'true'} WHERE NOT c.done GROUP BY c.r, p.pid)""")
        out.append(f"""{mean} AS MATERIALIZED (
  SELECT r, cluster, list(v ORDER BY pos) AS f FROM (
    SELECT n.r, n.cluster, x.pos, sum(n.w * x.v) / sum(n.w) AS v
    FROM {near} n, unnest(n.f) WITH ORDINALITY AS x(v, pos) GROUP BY ALL) GROUP BY r, cluster)""")
        stop = f"max(list_distance(c.f, coalesce(m.f, c.f))) OVER (PARTITION BY c.r) <= {tol}" if tol else "false"
        out.append(f"""{new} AS MATERIALIZED (
  SELECT c.r, c.cluster, coalesce(m.f, c.f) AS f, c.done OR {stop} AS done
  FROM {prev} c LEFT JOIN {mean} m ON m.r = c.r AND m.cluster = c.cluster)""")
        prev = new
    return out, prev


def fit_sql(runs: Sequence[Run], rounds: int, tol: float, max_iter: int = 20) -> list[str]:
    """The CTEs after ``pts``."""
    ctes = [f"""points AS MATERIALIZED (
  SELECT row_number() OVER () AS pid, f, w,
         CAST('0x' || substr(md5(CAST(i AS VARCHAR)), 1, 8) AS BIGINT) % {PRIME} AS b1,
         CAST('0x' || substr(md5(CAST(i AS VARCHAR)), 9, 8) AS BIGINT) % {PRIME} AS b2
  FROM (SELECT f, count(*) AS w, min(id) AS i FROM pts GROUP BY f))""",
            "draw(r, tag, a1, c1, a2, c2) AS MATERIALIZED (VALUES " + _draws(runs, rounds) + ")",
            "run(r, k, seed) AS (VALUES " + ", ".join(f"({r}, {x.k}, {x.seed})" for r, x in enumerate(runs)) + ")",
            f"""cand0 AS MATERIALIZED (
  SELECT r, 0::BIGINT AS cid, f, b1, b2 FROM points CROSS JOIN draw WHERE tag = 'first'
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY -ln({_U}) / w, b1, b2) = 1)"""]
    for i in range(rounds):
        ctes.append(f"""gap{i} AS MATERIALIZED (
  SELECT c.r, p.pid, any_value(p.f) AS f, any_value(p.w) AS w, any_value(p.b1) AS b1, any_value(p.b2) AS b2,
         min(list_distance(p.f, c.f)) AS m FROM points p CROSS JOIN cand{i} c GROUP BY c.r, p.pid)""")
        ctes.append(f"""new{i} AS MATERIALIZED (
  SELECT g.r, row_number() OVER (PARTITION BY g.r ORDER BY -ln({_U}) / (w * (m * m)), b1, b2) AS place, f, b1, b2
  FROM gap{i} g JOIN draw d ON d.r = g.r AND d.tag = 'round{i}' WHERE m > 0)""")
        ctes.append(f"""cand{i + 1} AS MATERIALIZED (
  SELECT * FROM cand{i} UNION ALL
  SELECT n.r, (SELECT max(cid) FROM cand{i} c WHERE c.r = n.r) + place, n.f, n.b1, n.b2
  FROM new{i} n JOIN run USING (r) WHERE place <= {OVERSAMPLE} * k)""")
    ctes.append(f"""wt AS MATERIALIZED (
  SELECT r, cid, sum(w)::DOUBLE AS w FROM (
    SELECT c.r, p.pid, any_value(p.w) AS w, arg_min(c.cid, (list_distance(p.f, c.f), c.cid)) AS cid
    FROM points p CROSS JOIN cand{rounds} c GROUP BY c.r, p.pid) GROUP BY r, cid)""")
    ctes.append(f"""cw AS MATERIALIZED (
  SELECT c.r, c.cid AS pid, c.f, c.b1, c.b2, wt.w FROM cand{rounds} c JOIN wt ON wt.r = c.r AND wt.cid = c.cid)""")
    for j in range(max(x.k for x in runs)):
        gap = ("SELECT *, 1.0 AS m FROM cw" if j == 0 else
               f"""SELECT c.r, c.pid, any_value(c.f) AS f, any_value(c.b1) AS b1, any_value(c.b2) AS b2,
           any_value(c.w) AS w, min(list_distance(c.f, p.f)) AS m
    FROM cw c JOIN pick{j - 1} p ON p.r = c.r GROUP BY c.r, c.pid""")
        one = f"""SELECT c.r, {j} AS cluster, f FROM ({gap}) c
  JOIN draw d ON d.r = c.r AND d.tag = 'pick{j}' WHERE m > 0
  QUALIFY row_number() OVER (PARTITION BY c.r ORDER BY -ln({_U}) / (w * (m * m)), b1, b2) = 1"""
        ctes.append(f"pick{j} AS MATERIALIZED ({one if j == 0 else f'SELECT * FROM pick{j - 1} UNION ALL ({one})'})")
    ctes.append(f"open0 AS (SELECT *, false AS done FROM pick{max(x.k for x in runs) - 1})")
    local, start = _lloyd("l", "cw", "open0", LOCAL_STEPS, None)
    steps, end = _lloyd("g", "points", start, max_iter, repr(tol))
    ctes += local + steps
    ctes.append(f"fit AS MATERIALIZED (SELECT r, cluster, f FROM {end})")
    ctes.append("""fitted AS MATERIALIZED (
  SELECT r, k, seed, sum(w * (m * m)) AS cost, sum(w * m) / sum(w) AS mean_distance FROM (
    SELECT c.r, p.pid, any_value(p.w) AS w, min(list_distance(p.f, c.f)) AS m
    FROM points p CROSS JOIN fit c GROUP BY c.r, p.pid) JOIN run USING (r) GROUP BY r, k, seed)""")
    return ctes


BEST = """best AS (
  SELECT r, k, mean_distance FROM fitted QUALIFY row_number() OVER (PARTITION BY k ORDER BY cost, seed) = 1)"""


# z-scored points: raw(id, f) -> pts(id, f)
ZSCORED = """parts AS (SELECT r.id, x.v, x.pos FROM raw r, unnest(r.f) WITH ORDINALITY AS x(v, pos)),
moments AS MATERIALIZED (SELECT pos, avg(v) AS mu, stddev_pop(v) AS sd FROM parts GROUP BY pos),
pts AS MATERIALIZED (
  SELECT id, list(CASE WHEN sd > 0 THEN (v - mu) / sd ELSE v - mu END ORDER BY pos) AS f
  FROM parts JOIN moments USING (pos) GROUP BY id)"""

# every point under the best run: under(id, cluster, dist)
UNDER_BEST = """under AS MATERIALIZED (
  SELECT p.id, min(list_distance(p.f, c.f)) AS dist,
         arg_min(c.cluster, (list_distance(p.f, c.f), c.cluster)) AS cluster
  FROM pts p CROSS JOIN fit c JOIN best USING (r) GROUP BY p.id),
limit_ AS (SELECT min(dist) AS t FROM (SELECT dist FROM under ORDER BY dist DESC LIMIT 100))"""


def under_best(pts: str, runs: Sequence[Run], rounds: int, tol: float) -> str:
    """``WITH`` list up to ``under`` and ``limit_`` (the 100th largest distance)."""
    return "WITH " + ",\n".join([pts, *fit_sql(runs, rounds, tol), BEST, UNDER_BEST])


def entropy_sweep_sql(pts: str, runs: Sequence[Run], rounds: int, tol: float) -> str:
    """``k, score`` by weighted label entropy; ``pts`` also gives ``lab(id, label)``."""
    return ("WITH " + ",\n".join([pts, *fit_sql(runs, rounds, tol), BEST]) + """,
near AS (SELECT b.k, p.id, arg_min(c.cluster, (list_distance(p.f, c.f), c.cluster)) AS cluster
         FROM pts p CROSS JOIN fit c JOIN best b USING (r) GROUP BY b.k, p.id),
made AS (SELECT k, cluster, label, count(*) AS n FROM near JOIN lab USING (id) GROUP BY ALL),
share AS (SELECT k, n, n / sum(n) OVER (PARTITION BY k, cluster) AS p FROM made)
SELECT CAST(k AS INTEGER) AS k, (round(sum(-n * ln(p)) / sum(n), 6) + 0.0) AS score FROM share GROUP BY k""")


def centers_sql(pts: str, runs: Sequence[Run], rounds: int, tol: float) -> str:
    """``cluster, pos, value`` of the best run."""
    return ("WITH " + ",\n".join([pts, *fit_sql(runs, rounds, tol), BEST]) + """
SELECT CAST(cluster AS INTEGER) AS cluster, CAST(x.pos - 1 AS INTEGER) AS pos, (round(x.v, 6) + 0.0) AS value
FROM fit JOIN best USING (r), unnest(fit.f) WITH ORDINALITY AS x(v, pos)""")


def sweep_sql(pts: str, runs: Sequence[Run], rounds: int, tol: float) -> str:
    """``k, score`` by mean distance."""
    return ("WITH " + ",\n".join([pts, *fit_sql(runs, rounds, tol), BEST]) + """
SELECT CAST(k AS INTEGER) AS k, (round(mean_distance, 6) + 0.0) AS score FROM best""")
