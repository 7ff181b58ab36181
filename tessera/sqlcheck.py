"""DuckDB-side definitions used by the correctness oracles.

The same fixture volumes (FIXTURES.md V1-V5) written as SQL over the raw
tables, plus SQL spellings of the pinned numeric rules.  The oracle queries
compute each operator the straightforward way (direct RANGE windows, direct
joins), independently of the Spark plans.
"""

from __future__ import annotations

import math

V1 = """v1 AS (
  SELECT CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, CAST(0 AS BIGINT) AS z, CAST(e AS DOUBLE) AS v
  FROM (SELECT vec_id AS y, unnest(range(len(embedding))) AS x, unnest(embedding) AS e FROM embeddings))"""

V2 = """v2 AS (
  SELECT CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, CAST(0 AS BIGINT) AS z,
         CAST(floor((CAST(e AS DOUBLE) + 1) * 32768) AS BIGINT) AS v
  FROM (SELECT vec_id AS y, unnest(range(len(embedding))) AS x, unnest(embedding) AS e FROM embeddings))"""

V3 = """v3 AS (
  SELECT CAST(hour(ts) AS BIGINT) AS x, CAST(day(ts) - 1 AS BIGINT) AS y, CAST(t.z AS BIGINT) AS z, COUNT(*) AS v
  FROM events JOIN (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS z
                    FROM (SELECT DISTINCT event_type FROM events)) t USING (event_type)
  GROUP BY 1, 2, 3)"""

V4 = """v4 AS (
  SELECT CAST(l_suppkey AS BIGINT) AS x, CAST(l_quantity - 1 AS BIGINT) AS y,
         CAST(l_linenumber - 1 AS BIGINT) AS z, COUNT(*) AS v
  FROM lineitem GROUP BY 1, 2, 3)"""

V5 = """v5 AS (
  SELECT CAST(l_suppkey AS BIGINT) AS x, CAST(l_quantity - 1 AS BIGINT) AS y,
         CAST(l_linenumber - 1 AS BIGINT) AS z, CAST(SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS v
  FROM lineitem GROUP BY 1, 2, 3)"""

# dims of V2 / V4 as one-row CTEs
V2DIMS = """v2dims AS (SELECT CAST(max(len(embedding)) AS BIGINT) AS nx, CAST(max(vec_id) + 1 AS BIGINT) AS ny FROM embeddings)"""
V4DIMS = """v4dims AS (SELECT CAST(max(l_suppkey) + 1 AS BIGINT) AS nx, CAST(max(l_quantity) AS BIGINT) AS ny,
  CAST(max(l_linenumber) AS BIGINT) AS nz FROM lineitem)"""
V3DIMS = """v3dims AS (SELECT max(x) + 1 AS nx, max(y) + 1 AS ny, max(z) + 1 AS nz FROM v3)"""
NX4, NY4, NZ4 = (f"(SELECT {n} FROM v4dims)" for n in ("nx", "ny", "nz"))


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def lit(x: float) -> str:
    x = float(x)
    if math.isinf(x):
        return "CAST('inf' AS DOUBLE)" if x > 0 else "CAST('-inf' AS DOUBLE)"
    if math.isnan(x):
        return "CAST('nan' AS DOUBLE)"
    return f"CAST({x!r} AS DOUBLE)"


def rnd(e: str) -> str:
    """P1 in SQL."""
    return f"(CASE WHEN ({e}) >= 0 THEN floor(({e}) + 0.5) ELSE ceil(({e}) - 0.5) END)"


def to_int(e: str, lo: int, hi: int, sql_type: str) -> str:
    """P1 + P2: saturate, NaN -> 0, round, cast."""
    return (f"CAST(CASE WHEN isnan({e}) THEN 0 WHEN ({e}) <= {lo} THEN {lo} WHEN ({e}) >= {hi} THEN {hi} "
            f"ELSE {rnd(e)} END AS {sql_type})")


def ieee_div(a: str, b: str) -> str:
    return (f"(CASE WHEN ({b}) = 0 THEN (CASE WHEN ({a}) > 0 THEN CAST('inf' AS DOUBLE) "
            f"WHEN ({a}) < 0 THEN CAST('-inf' AS DOUBLE) ELSE CAST('nan' AS DOUBLE) END) "
            f"ELSE CAST({a} AS DOUBLE) / ({b}) END)")


def clamp(e: str, lo: float, hi: float) -> str:
    return f"(CASE WHEN isnan({e}) THEN ({e}) ELSE least({lit(hi)}, greatest({lit(lo)}, {e})) END)"


def f32(e: str) -> str:
    return f"CAST(CAST({e} AS FLOAT) AS DOUBLE)"


def mirror_single(i: str, n: str) -> str:
    """C8 in SQL; ``n`` may be an expression.  ``%`` truncates, so take it twice."""
    p = f"(2 * ({n}) - 2)"
    m = f"((({i}) % {p} + {p}) % {p})"
    return f"(CASE WHEN ({n}) = 1 THEN 0 WHEN {m} < ({n}) THEN {m} ELSE {p} - {m} END)"


def mirror_double(i: str, n: str) -> str:
    p = f"(2 * ({n}))"
    m = f"((({i}) % {p} + {p}) % {p})"
    return f"(CASE WHEN {m} < ({n}) THEN {m} ELSE {p} - 1 - {m} END)"


def unrotated(x: str, y: str, z: str) -> list[str]:
    """The view-plane transform (rotate z 0.3, y 0.1, x 0.6, scale 0.9) undone, written out axis by axis."""
    qx, qy, qz = (f"({c} / 0.9)" for c in (x, y, z))
    ay, az = f"(cos(0.6) * {qy} + sin(0.6) * {qz})", f"(cos(0.6) * {qz} - sin(0.6) * {qy})"
    bx, bz = f"(cos(0.1) * {qx} - sin(0.1) * {az})", f"(sin(0.1) * {qx} + cos(0.1) * {az})"
    return [f"(cos(0.3) * {bx} + sin(0.3) * {ay})", f"(cos(0.3) * {ay} - sin(0.3) * {bx})", bz]


def dense_sql(name: str, src: str) -> str:
    """CTE: every voxel of V4's interval, 0 where ``src`` has no row."""
    return f"""{name} AS (SELECT tx.i AS x, ty.i AS y, tz.i AS z, COALESCE(s.v, 0) AS v
  FROM range(0, {NX4}) tx(i) CROSS JOIN range(0, {NY4}) ty(i) CROSS JOIN range(0, {NZ4}) tz(i)
  LEFT JOIN {src} s ON s.x = tx.i AND s.y = ty.i AND s.z = tz.i)"""


def jacobi_sql(src: str, sweeps: int = 6) -> tuple[list[str], str]:
    """CTEs of cyclic Jacobi rotations on a symmetric 3x3 matrix (columns a00, a01, a02, a11, a12, a22 of ``src``,
    with x, y, z); in the last one a00, a11, a22 are the eigenvalues."""
    ctes, cur = [], src
    for k, (p, r) in enumerate([(0, 1), (0, 2), (1, 2)] * sweeps):
        o = 3 - p - r
        n = lambda i, j: f"a{min(i, j)}{max(i, j)}"
        app, arr, apr, aop, aor = n(p, p), n(r, r), n(p, r), n(o, p), n(o, r)
        th = f"(({arr} - {app}) / (2.0 * {apr}))"
        t = f"CASE WHEN {apr} = 0 THEN 0.0 ELSE (CASE WHEN {th} >= 0 THEN 1.0 ELSE -1.0 END) / (abs({th}) + sqrt({th} * {th} + 1.0)) END"
        ctes.append(f"jt{k} AS (SELECT *, {t} AS t FROM {cur})")
        ctes.append(f"jc{k} AS (SELECT *, 1.0 / sqrt(t * t + 1.0) AS c FROM jt{k})")
        new = {app: f"{app} - t * {apr}", arr: f"{arr} + t * {apr}", apr: "0.0", aop: f"c * {aop} - t * c * {aor}",
               aor: f"t * c * {aop} + c * {aor}"}
        cols = ", ".join(f"{new.get(a, a)} AS {a}" for a in ("a00", "a01", "a02", "a11", "a12", "a22"))
        cur = f"jr{k}"
        ctes.append(f"{cur} AS MATERIALIZED (SELECT x, y, z, {cols} FROM jc{k})")
    return ctes, cur


def box_window_sql(src: str, r: int, out: str = "boxed", vexpr: str = "v") -> str:
    """Two CTEs: RANGE-window sums over x then y (direct frames, no prefix trick)."""
    return f"""{out}_1 AS (
  SELECT x, y, z, {vexpr} AS v,
    SUM({vexpr}) OVER (PARTITION BY z, y ORDER BY x RANGE BETWEEN {r} PRECEDING AND {r} FOLLOWING) AS s1,
    SUM(({vexpr}) * ({vexpr})) OVER (PARTITION BY z, y ORDER BY x RANGE BETWEEN {r} PRECEDING AND {r} FOLLOWING) AS q1
  FROM {src}),
{out} AS (
  SELECT x, y, z, v,
    SUM(s1) OVER (PARTITION BY z, x ORDER BY y RANGE BETWEEN {r} PRECEDING AND {r} FOLLOWING) AS S,
    SUM(q1) OVER (PARTITION BY z, x ORDER BY y RANGE BETWEEN {r} PRECEDING AND {r} FOLLOWING) AS Q
  FROM {out}_1)"""


def stats_sql(r: int) -> tuple[str, str, str]:
    bs = (2 * r + 1) ** 2
    mean = f"(CAST(S AS DOUBLE) * {lit(1.0 / bs)})"
    var = f"({lit(1.0 / (bs - 1))} * CAST(Q AS DOUBLE) - {lit(1.0 / (bs * bs - bs))} * CAST(S AS DOUBLE) * CAST(S AS DOUBLE))"
    std = f"(CASE WHEN {var} < 0 THEN 0.0 ELSE sqrt({var}) END)"
    return mean, var, std


def soft_limit_sql(x: str, limit: float, gamma: float) -> str:
    g = 1.0 / math.pow(gamma, 1.0 / (gamma - 1.0))
    a, b = g - limit, limit - math.pow(g, gamma)
    return f"(CASE WHEN ({x}) < {lit(limit)} THEN ({x}) ELSE pow(({x}) + {lit(a)}, {lit(gamma)}) + {lit(b)} END)"


def cllcn_sql(r: int, k=3.0, limit=10.0, gamma=0.5, center=True, stretch=True, keep=True,
              fp_min=0.0, fp_max=65535.0) -> str:
    """G8 in SQL over columns v, S, Q; the float result before clamping."""
    mean, _, std = stats_sql(r)
    L = fp_max - fp_min
    fpmean = L / 2.0 + fp_min
    v = f32("v")
    d = f"({lit(k)} * {std})"
    if gamma == 1:
        if center and stretch:
            return f"({ieee_div(f'({v} - ({mean} - {d})) / 2.0', d)} * {lit(L)} + {lit(fp_min)})"
        if center:
            return f"(({v} - {mean}) + {lit(fpmean)})"
        if stretch:
            return f"({ieee_div(f'({v} - {lit(fpmean)}) / 2.0', d)} * {lit(L)} + {lit(fpmean)})"
        return v
    s = f"(CASE WHEN {d} = 0 THEN 0.0 ELSE 0.5 * {soft_limit_sql(ieee_div('1.0', d) + ' * ' + lit(L), limit, gamma)} END)"
    if center and stretch:
        vmin = f"({mean} - {ieee_div(lit(L), s)} * 0.5)"
        out = f"(({v} - {vmin}) * {s} + {lit(fp_min)})"
        if keep:
            out = f"(CASE WHEN {v} = {lit(fp_min)} OR {v} = {lit(fp_max)} THEN {v} ELSE {out} END)"
        return out
    if center:
        return f"(({v} - {mean}) + {lit(fpmean)})"
    if stretch:
        return f"(({v} - {lit(fpmean)}) * {s} * {lit(L)} + {lit(fpmean)})"
    return v
