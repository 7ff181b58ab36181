"""G: local statistics and contrast normalisation on V2 (embedding image as u16)."""

from __future__ import annotations

from .. import sqlcheck as q
from ..catalog import register
from ..operators import localstats as ls
from ..sources import fixtures as fx

R = 5


def _cllcn_oracle(r, extension="zero", **kw) -> str:
    f = q.cllcn_sql(r, **kw)
    stored = q.f32(f)
    out = q.to_int(q.clamp(stored, 0.0, 65535.0), 0, 65535, "INTEGER")
    if extension == "zero":
        return (q.with_(q.V2, q.box_window_sql("v2", r))
                + f"SELECT x, y, z, {out} AS v FROM boxed")
    mirror = q.mirror_single if extension == "mirror_single" else q.mirror_double
    padded = f"""padded AS (
  SELECT tx.i AS x, ty.j AS y, v2.z AS z, v2.v AS v
  FROM v2dims, range(-{r}, (SELECT nx FROM v2dims) + {r}) tx(i), range(-{r}, (SELECT ny FROM v2dims) + {r}) ty(j), v2
  WHERE v2.x = {mirror('tx.i', 'v2dims.nx')} AND v2.y = {mirror('ty.j', 'v2dims.ny')})"""
    return (q.with_(q.V2, q.V2DIMS, padded, q.box_window_sql("padded", r))
            + f"SELECT x, y, z, {out} AS v FROM boxed, v2dims WHERE x BETWEEN 0 AND nx - 1 AND y BETWEEN 0 AND ny - 1")


@register("cllcn", _cllcn_oracle(R))
def cllcn(spark, sf_dir):
    """Contrast-limited local contrast normalisation, r=5, zero border (the job's parameters)."""
    return ls.cllcn(fx.embedding_u16(spark, sf_dir), R, 3.0, 10.0, 0.5, True, True, True, "zero").df


@register("cllcn_mirror", _cllcn_oracle(7, "mirror_single"))
def cllcn_mirror(spark, sf_dir):
    """The notebook variant with a mirror-single border (r=7 here)."""
    return ls.cllcn(fx.embedding_u16(spark, sf_dir), 7, 3.0, 10.0, 0.5, True, True, True, "mirror_single").df


@register("cllcn_center", _cllcn_oracle(R, center=True, stretch=False))
def cllcn_center(spark, sf_dir):
    """runCenter."""
    return ls.cllcn(fx.embedding_u16(spark, sf_dir), R, center=True, stretch=False).df


@register("cllcn_stretch", _cllcn_oracle(R, gamma=1.0, center=False, stretch=True))
def cllcn_stretch(spark, sf_dir):
    """runStretch with gamma = 1."""
    return ls.cllcn(fx.embedding_u16(spark, sf_dir), R, gamma=1.0, center=False, stretch=True).df


@register("cllcn_stretch_limited", _cllcn_oracle(R, gamma=0.5, center=False, stretch=True))
def cllcn_stretch_limited(spark, sf_dir):
    """runStretch with the soft limiter."""
    return ls.cllcn(fx.embedding_u16(spark, sf_dir), R, gamma=0.5, center=False, stretch=True).df


@register("cllcn_center_stretch", _cllcn_oracle(R, gamma=1.0, center=True, stretch=True))
def cllcn_center_stretch(spark, sf_dir):
    """runCenterStretch with gamma = 1."""
    return ls.cllcn(fx.embedding_u16(spark, sf_dir), R, gamma=1.0, center=True, stretch=True).df


@register("cllcn_nokeep", _cllcn_oracle(R, keep=False))
def cllcn_nokeep(spark, sf_dir):
    """G7 without keepMinMax."""
    return ls.cllcn(fx.embedding_u16(spark, sf_dir), R, keep_min_max=False).df


@register("lcn", _cllcn_oracle(4, "mirror_single", gamma=1.0, center=True, stretch=True, keep=False))
def lcn(spark, sf_dir):
    """Local contrast normalisation (pinned as G8 with gamma = 1), mirror-single border."""
    return ls.normalize_local_contrast(fx.embedding_u16(spark, sf_dir), 4).df


def _box_oracle(r):
    mean, var, std = q.stats_sql(r)
    return (q.with_(q.V2, q.box_window_sql("v2", r))
            + f"SELECT x, y, z, v, CAST(S AS BIGINT) AS S, CAST(Q AS BIGINT) AS Q, {mean} AS mean, {var} AS var, {std} AS std FROM boxed")


@register("box_stats", _box_oracle(3))
def box_stats(spark, sf_dir):
    """Window sum, sum of squares, mean, sample variance, std (full windows, zero border)."""
    return ls.box_stats(fx.embedding_u16(spark, sf_dir), 3)


def _clahe_sql(r, bins=256, slope=3.0, lo=0.0, hi=65535.0, src=None, dims=None):
    """``src``: CTEs that end with a dense volume v2, ``dims``: the CTE of its dims under the name v2dims."""
    T = 2 * r + 1
    span = hi - lo + 1
    return q.with_(*(src or [q.V2]), dims or q.V2DIMS, f"""vox AS (SELECT x, y, z, v, x // {T} AS tx, y // {T} AS ty,
    CAST(least({bins - 1}, greatest(0, floor((CAST(v AS DOUBLE) - {q.lit(lo)}) * {q.lit(bins)} / {q.lit(span)}))) AS INTEGER) AS b FROM v2),
hist AS (SELECT z, tx, ty, b, COUNT(*) AS h FROM vox GROUP BY z, tx, ty, b),
tiles AS (SELECT z, tx, ty, SUM(h) AS n FROM hist GROUP BY z, tx, ty),
fullb AS (SELECT t.z, t.tx, t.ty, bb.b, t.n, CAST(COALESCE(h.h, 0) AS DOUBLE) AS h
  FROM tiles t CROSS JOIN range(0, {bins}) bb(b) LEFT JOIN hist h ON h.z = t.z AND h.tx = t.tx AND h.ty = t.ty AND h.b = bb.b),
clip AS (SELECT *, least(h, {q.lit(slope)} * CAST(n AS DOUBLE) / {q.lit(bins)}) AS c FROM fullb),
maps AS (SELECT z, tx, ty, b, {q.lit(lo)} + {q.lit(hi - lo)} * (
    SUM(c) OVER (PARTITION BY z, tx, ty ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    + CAST(b + 1 AS DOUBLE) * SUM(h - c) OVER (PARTITION BY z, tx, ty) / {q.lit(bins)}) / CAST(n AS DOUBLE) AS m FROM clip),
pos AS (SELECT x, y, z, b, floor((CAST(x AS DOUBLE) - {q.lit(r)}) / {q.lit(T)}) AS fx, floor((CAST(y AS DOUBLE) - {q.lit(r)}) / {q.lit(T)}) AS fy,
    (CAST(x AS DOUBLE) - {q.lit(r)}) / {q.lit(T)} - floor((CAST(x AS DOUBLE) - {q.lit(r)}) / {q.lit(T)}) AS wx,
    (CAST(y AS DOUBLE) - {q.lit(r)}) / {q.lit(T)} - floor((CAST(y AS DOUBLE) - {q.lit(r)}) / {q.lit(T)}) AS wy FROM vox),
look AS (SELECT x, y, z, b,
    CAST(least((SELECT (nx + {T - 1}) // {T} FROM v2dims) - 1, greatest(0, fx + kx)) AS BIGINT) AS tx,
    CAST(least((SELECT (ny + {T - 1}) // {T} FROM v2dims) - 1, greatest(0, fy + ky)) AS BIGINT) AS ty,
    (CASE WHEN kx = 1 THEN wx ELSE 1.0 - wx END) * (CASE WHEN ky = 1 THEN wy ELSE 1.0 - wy END) AS w
  FROM pos CROSS JOIN (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) c(kx, ky))""") + f"""
SELECT look.x, look.y, look.z, {q.to_int('SUM(look.w * maps.m)', 0, 65535, 'INTEGER')} AS v
FROM look JOIN maps ON maps.z = look.z AND maps.tx = look.tx AND maps.ty = look.ty AND maps.b = look.b
GROUP BY look.x, look.y, look.z"""


@register("clahe", _clahe_sql(5))
def clahe(spark, sf_dir):
    """G10 (P8): CLAHE with tiles of 2r+1 = 11, 256 bins, slope 3, range 0..65535."""
    from ..operators.clahe import clahe as run
    return run(fx.embedding_u16(spark, sf_dir), 5).df
