"""F: gradients, Hessian and tubeness on V2 (dense) and V4 (sparse)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sqlcheck as q
from ..catalog import register
from ..operators import stencil as S
from ..sources import fixtures as fx


def _nb(src, alias, dx=0, dy=0, dz=0, c="c"):
    return (f"LEFT JOIN {src} {alias} ON {alias}.x = {c}.x + ({dx}) AND {alias}.y = {c}.y + ({dy}) "
            f"AND {alias}.z = {c}.z + ({dz})")


def _v(alias, col="v"):
    return f"CAST(COALESCE({alias}.{col}, 0) AS DOUBLE)"


V4DENSE = """d4 AS (SELECT tx.i AS x, ty.i AS y, tz.i AS z, COALESCE(v4.v, 0) AS v
  FROM range(0, (SELECT nx FROM v4dims)) tx(i) CROSS JOIN range(0, (SELECT ny FROM v4dims)) ty(i) CROSS JOIN range(0, (SELECT nz FROM v4dims)) tz(i)
  LEFT JOIN v4 ON v4.x = tx.i AND v4.y = ty.i AND v4.z = tz.i)"""


@register("gradient_center", q.with_(q.V2) + f"""SELECT c.x, c.y, c.z, ({_v('n')} - {_v('p')}) * 0.5 AS v
FROM v2 c {_nb('v2', 'n', dx=1)} {_nb('v2', 'p', dx=-1)}""")
def gradient_center(spark, sf_dir):
    """F1: 0.5*(s(x+1) - s(x-1)) along x, zero outside."""
    return S.center_gradient(fx.embedding_u16(spark, sf_dir), 0, "zero", dense=True).df


@register("gradient_center_rai", q.with_(q.V2, q.V2DIMS) + f"""SELECT c.x, c.y, c.z, ({_v('n')} - {_v('p')}) * 0.5 AS v
FROM v2dims, v2 c
LEFT JOIN v2 n ON n.x = c.x AND n.z = c.z AND n.y = {q.mirror_single('c.y + 1', '(SELECT ny FROM v2dims)')}
LEFT JOIN v2 p ON p.x = c.x AND p.z = c.z AND p.y = {q.mirror_single('c.y - 1', '(SELECT ny FROM v2dims)')}""")
def gradient_center_rai(spark, sf_dir):
    """centre gradient along y with mirror-single border (0 at both ends)."""
    return S.center_gradient(fx.embedding_u16(spark, sf_dir), 1, "mirror_single", dense=True).df


@register("gradient_forward", q.with_(q.V4, q.V4DIMS, V4DENSE) + f"""SELECT c.x, c.y, c.z, {_v('n')} - {_v('c')} AS v
FROM d4 c {_nb('d4', 'n', dy=1)}""")
def gradient_forward(spark, sf_dir):
    """s(y+1) - s(y) on V4 (sparse, densified; zero beyond the end)."""
    return S.gradient_forward(fx.lineitem_counts(spark, sf_dir), 1, "zero").df


@register("gradient_sigma", q.with_(q.V2) + f"""SELECT c.x, c.y, c.z, ({_v('n')} - {_v('p')}) * {q.lit(2.0 / 3.0)} AS v
FROM v2 c {_nb('v2', 'n', dy=1)} {_nb('v2', 'p', dy=-1)}""")
def gradient_sigma(spark, sf_dir):
    """(s(y+1) - s(y-1)) * 2/sigma with sigma = 3."""
    return S.center_gradient(fx.embedding_u16(spark, sf_dir), 1, "zero", sigma=3.0, dense=True).df


@register("gradient_magnitude", q.with_(q.V2) + f"""SELECT x, y, z, sqrt(g0 * g0 + g1 * g1) AS v FROM (
  SELECT c.x, c.y, c.z, ({_v('nx')} - {_v('px')}) * {q.lit(1.0)} AS g0, ({_v('ny')} - {_v('py')}) * {q.lit(2.0 / 3.0)} AS g1
  FROM v2 c {_nb('v2', 'nx', dx=1)} {_nb('v2', 'px', dx=-1)} {_nb('v2', 'ny', dy=1)} {_nb('v2', 'py', dy=-1)})""")
def gradient_magnitude(spark, sf_dir):
    """|grad| with per-axis 2/sigma norms, sigma = (2, 3), 2-D."""
    return S.gradient_magnitude(fx.embedding_u16(spark, sf_dir), (2.0, 3.0), "zero", dense=True).df


@register("gradient_magnitude_3d", q.with_(q.V4, q.V4DIMS, V4DENSE) + f"""SELECT x, y, z, sqrt(g0 * g0 + g1 * g1 + g2 * g2) AS v FROM (
  SELECT c.x, c.y, c.z, ({_v('nx')} - {_v('px')}) * {q.lit(2.0)} AS g0, ({_v('ny')} - {_v('py')}) * {q.lit(1.0)} AS g1,
         ({_v('nz')} - {_v('pz')}) * {q.lit(0.5)} AS g2
  FROM d4 c {_nb('d4', 'nx', dx=1)} {_nb('d4', 'px', dx=-1)} {_nb('d4', 'ny', dy=1)} {_nb('d4', 'py', dy=-1)}
            {_nb('d4', 'nz', dz=1)} {_nb('d4', 'pz', dz=-1)})""")
def gradient_magnitude_3d(spark, sf_dir):
    """F5 in 3-D on V4 (sparse, densified), sigma = (1, 2, 4)."""
    return S.gradient_magnitude(fx.lineitem_counts(spark, sf_dir), (1.0, 2.0, 4.0), "zero").df


def _hessian_sql(sig=(2.0, 2.0)):
    n0, n1 = q.lit(2.0 / sig[0]), q.lit(2.0 / sig[1])
    return q.with_(q.V2, q.V2DIMS, f"""pad AS (SELECT tx.i AS x, ty.j AS y, CAST(0 AS BIGINT) AS z, COALESCE(v2.v, 0) AS v
  FROM range(-2, (SELECT nx FROM v2dims) + 2) tx(i) CROSS JOIN range(-2, (SELECT ny FROM v2dims) + 2) ty(j)
  LEFT JOIN v2 ON v2.x = tx.i AND v2.y = ty.j),
g AS (SELECT c.x, c.y, c.z, ({_v('a')} - {_v('b')}) * {n0} AS g0, ({_v('e')} - {_v('f')}) * {n1} AS g1
  FROM pad c {_nb('pad', 'a', dx=1)} {_nb('pad', 'b', dx=-1)} {_nb('pad', 'e', dy=1)} {_nb('pad', 'f', dy=-1)}),
h AS (SELECT c.x, c.y, c.z, ({_v('a', 'g0')} - {_v('b', 'g0')}) * {n0} AS h00, ({_v('a', 'g1')} - {_v('b', 'g1')}) * {n1} AS h01,
        ({_v('e', 'g1')} - {_v('f', 'g1')}) * {n1} AS h11
  FROM g c {_nb('g', 'a', dx=1)} {_nb('g', 'b', dx=-1)} {_nb('g', 'e', dy=1)} {_nb('g', 'f', dy=-1)}
  WHERE c.x BETWEEN 0 AND (SELECT nx FROM v2dims) - 1 AND c.y BETWEEN 0 AND (SELECT ny FROM v2dims) - 1)""")


@register("hessian_2d", _hessian_sql() + "SELECT x, y, z, h00, h01, h11 FROM h")
def hessian_2d(spark, sf_dir):
    """Hessian from centre gradients (sigma = 2), norm index e, zero border."""
    return S.hessian(fx.embedding_u16(spark, sf_dir), (2.0, 2.0), "zero")


@register("tubeness_2d", _hessian_sql() + """, ev AS (SELECT x, y, z, m - dd AS la, m + dd AS lb FROM (
  SELECT x, y, z, (h00 + h11) / 2.0 AS m, sqrt(((h00 - h11) / 2.0) * ((h00 - h11) / 2.0) + h01 * h01) AS dd FROM h)),
s AS (SELECT x, y, z, CASE WHEN abs(la) > abs(lb) THEN la ELSE lb END AS l1, CASE WHEN abs(la) > abs(lb) THEN lb ELSE la END AS l0 FROM ev)
SELECT x, y, z, round(CASE WHEN l1 < 0 THEN -l1 - abs(l0) WHEN l1 > 0 THEN -(l1 - abs(l0)) ELSE 0.0 END, 6) + 0.0 AS v FROM s""")
def tubeness_2d(spark, sf_dir):
    """F7 (n = 2): +-(|l1| - |l0|) from the Hessian eigenvalues (closed form), sigma = 2."""
    t = S.tubeness(fx.embedding_u16(spark, sf_dir), (2.0, 2.0), "zero")
    # + 0.0 turns -0.0 into +0.0, so both engines print the same zeros
    return t.df.select("x", "y", "z", (F.round("v", 6) + F.lit(0.0)).alias("v"))


def _tubeness_3d_sql(sig=1.0):
    """Hessian by neighbour joins, eigenvalues by Jacobi rotations, then the rule for n = 3."""
    n = q.lit(2.0 / sig)
    pad = """pad AS (SELECT tx.i AS x, ty.i AS y, tz.i AS z, CAST(COALESCE(v4.v, 0) AS DOUBLE) AS v
  FROM range(-2, (SELECT nx FROM v4dims) + 2) tx(i) CROSS JOIN range(-2, (SELECT ny FROM v4dims) + 2) ty(i)
  CROSS JOIN range(-2, (SELECT nz FROM v4dims) + 2) tz(i) LEFT JOIN v4 ON v4.x = tx.i AND v4.y = ty.i AND v4.z = tz.i)"""
    step = [dict(dx=1), dict(dy=1), dict(dz=1)]
    back = [dict(dx=-1), dict(dy=-1), dict(dz=-1)]
    joins = lambda src: " ".join(_nb(src, f"n{d}", **step[d]) + " " + _nb(src, f"p{d}", **back[d]) for d in range(3))
    g = ", ".join(f"({_v(f'n{e}')} - {_v(f'p{e}')}) * {n} AS g{e}" for e in range(3))
    h = ", ".join(f"({_v(f'n{d}', f'g{e}')} - {_v(f'p{d}', f'g{e}')}) * {n} AS a{d}{e}" for d in range(3) for e in range(d, 3))
    rot, last = q.jacobi_sql("h")
    return q.with_(q.V4, q.V4DIMS, pad, f"g AS MATERIALIZED (SELECT c.x, c.y, c.z, {g} FROM pad c {joins('pad')})",
                   f"""h AS MATERIALIZED (SELECT c.x, c.y, c.z, {h} FROM g c {joins('g')}, v4dims
  WHERE c.x BETWEEN 0 AND nx - 1 AND c.y BETWEEN 0 AND ny - 1 AND c.z BETWEEN 0 AND nz - 1)""", *rot,
                   f"""e AS (SELECT x, y, z, list_sort([{{'m': abs(a00), 'l': a00}}, {{'m': abs(a11), 'l': a11}}, {{'m': abs(a22), 'l': a22}}]) AS s FROM {last}),
l AS (SELECT x, y, z, s[1].l AS l0, s[2].l AS l1, s[3].l AS l2 FROM e),
w AS (SELECT x, y, z, l0, l1, l2, CASE WHEN l2 < 0 THEN -1.0 ELSE 1.0 END AS sg FROM l)""") + """
SELECT x, y, z, round(CASE WHEN sg * l1 > 0 THEN sqrt(greatest(0.0, sg * l2 * (sg * l1 - abs(l0)))) / -l2 ELSE 0.0 END, 6) + 0.0 AS v FROM w"""


@register("tubeness_3d", _tubeness_3d_sql())
def tubeness_3d(spark, sf_dir):
    """F7 (n = 3) on V4: eigenvalues with numpy over Arrow batches; the oracle uses Jacobi rotations."""
    t = S.tubeness(fx.lineitem_counts(spark, sf_dir), (1.0, 1.0, 1.0), "zero")
    return t.df.select("x", "y", "z", (F.round("v", 6) + F.lit(0.0)).alias("v"))
