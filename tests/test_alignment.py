"""Blocks whose intervals differ: every operator keeps the interval, pairwise operators meet at equal coordinates."""

from dataclasses import replace

import numpy as np
import pytest
from conftest import to_array
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators import blockops as BO
from tessera.operators import blocks as B
from tessera.operators import clahe as C
from tessera.operators import convolve as CV
from tessera.operators import coords as CO
from tessera.operators import localstats as LS
from tessera.operators import pairwise as P
from tessera.operators import resample as RS
from tessera.operators import stencil as S

SPARK_SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SHIFT = (5, -3, 2)


def image(seed=1, shape=(3, 11, 13)):
    return np.random.default_rng(seed).integers(0, 60_000, shape).astype(np.uint16)


# block form and voxel form of operators that keep the interval
BOTH = {
    "retile": (lambda b: B.retile(b, (5, 3, 1)), lambda v: v),
    "map_blocks": (lambda b: B.map_blocks(b, lambda a: a, (1, 1, 0), "mirror_single"), lambda v: v),
    "map_slices": (lambda b: B.map_slices(b, lambda a: a, 1), lambda v: v),
    "map_pointwise": (lambda b: B.map_pointwise(b, lambda a: a), lambda v: v),
    "nonempty": (B.nonempty, lambda v: v),
    "gauss": (lambda b: B.gauss(b, (1.0, 1.0, 1.0), "mirror_double"), lambda v: CV.gauss(v, (1.0, 1.0, 1.0), "mirror_double")),
    "dog": (lambda b: B.dog(b, (1.0,) * 3, (2.0,) * 3), lambda v: CV.dog(v, (1.0,) * 3, (2.0,) * 3)),
    "convolve": (lambda b: BO.convolve_separable(b, [[0.5, 0.25], None, None]), lambda v: CV.convolve_separable(v, [[0.5, 0.25], None, None])),
    "center_gradient": (lambda b: B.center_gradient(b, 1), lambda v: S.center_gradient(v, 1, "mirror_single")),
    "center_gradient_by_views": (lambda b: BO.center_gradient_by_views(b, 0), lambda v: S.center_gradient(v, 0, "mirror_single")),
    "gradient_forward": (lambda b: BO.gradient_forward(b, 0), lambda v: S.gradient_forward(v, 0, "zero")),
    "gradient_magnitude": (lambda b: B.gradient_magnitude(b, (1.0, 2.0, 3.0)), lambda v: S.gradient_magnitude(v, (1.0, 2.0, 3.0), "zero")),
    "tubeness": (lambda b: BO.tubeness(b, (1.0,) * 3), lambda v: S.tubeness(v, (1.0,) * 3)),
    "cllcn": (lambda b: B.cllcn(b, 2), lambda v: LS.cllcn(v, 2)),
    "cllcn_running": (lambda b: B.cllcn(b, 2, strips=True), lambda v: LS.cllcn(v, 2)),
    "clahe": (lambda b: B.clahe(b, 2), lambda v: C.clahe(v, 2)),
    "clahe_halo": (lambda b: B.clahe(b, 2, halo=True), lambda v: C.clahe(v, 2)),
    "chain": (lambda b: B.center_gradient(B.center_gradient(b.chain(), 0), 1),
              lambda v: S.center_gradient(S.center_gradient(v, 0, "mirror_single"), 1, "mirror_single")),
}


@pytest.mark.parametrize("name", list(BOTH))
def test_operators_keep_the_interval(mk, name):
    """After translate and after crop, both forms give the same values at the same coordinates; attributes stay."""
    block_op, voxel_op = BOTH[name]
    vol = CO.translate(mk(image()), SHIFT)
    bv = B.from_voxels(vol, (4, 5, 2))
    bv = replace(bv, meta=replace(bv.meta, attrs={"unit": "nm"}))
    lo, size = (7, -1, 3), (9, 8, 2)
    for b, v in ((bv, vol), (BO.crop(bv, lo, size), CO.crop(vol, lo, size))):
        got, want = block_op(b), voxel_op(v)
        assert tuple(got.meta.min) == tuple(want.meta.min) == tuple(b.meta.min) and tuple(got.dims) == tuple(want.dims)
        assert got.meta.attrs == {"unit": "nm"}
        assert np.allclose(to_array(B.to_voxels(got)), to_array(want), rtol=1e-9, atol=1e-9)


OPS = {"add": (BO.add, P.add), "sub": (BO.sub, P.sub), "mul": (BO.mul, P.mul), "div": (BO.div, P.div),
       "max": (lambda a, b: BO.vmax([a, b]), lambda a, b: P.vmax([a, b]))}


@pytest.mark.parametrize("name", list(OPS))
@given(shift=st.tuples(st.integers(-14, 14), st.integers(-12, 12), st.integers(-3, 3)), ba=st.tuples(*[st.integers(1, 6)] * 3),
       bb=st.tuples(*[st.integers(1, 6)] * 3), seed=st.integers(0, 99))
@SPARK_SETTINGS
def test_pairwise_on_unequal_intervals(mk, name, shift, ba, bb, seed):
    """Different origins, sizes and blocks; the result lies on A's interval, the maximum on that which spans both."""
    a, b = mk(image(seed) % 200), CO.translate(mk(image(seed + 1, (2, 9, 14)) % 200), shift)
    block_op, voxel_op = OPS[name]
    got = block_op(B.from_voxels(a, ba), B.from_voxels(b, bb))
    want = voxel_op(a, b)
    assert tuple(got.meta.min) == tuple(want.meta.min) and tuple(got.dims) == tuple(want.dims) and tuple(got.block) == ba
    assert name == "max" or tuple(got.meta.min) == tuple(a.meta.min) and tuple(got.dims) == tuple(a.dims)
    assert np.array_equal(to_array(B.to_voxels(got)), to_array(want), equal_nan=True)


def test_pair_and_cell_on_unequal_intervals(mk):
    a, b = mk(image(3)), CO.translate(mk(image(4)), (3, 2, 1))
    ba, bb = B.from_voxels(a, (4, 4, 2)), B.from_voxels(b, (3, 5, 1))
    got = B.channels_to_voxels(BO.pair(ba, bb), ["a", "b"]).where("b <> 0").orderBy("x", "y", "z").toPandas()
    want = P.pair(a, b).where("b <> 0").orderBy("x", "y", "z").toPandas()
    assert np.array_equal(got.to_numpy(float), want.to_numpy(float))
    cell = to_array(B.to_voxels(BO.multiply_cell(ba, bb, (4, 3, 1), (5, 6, 2))))
    assert np.array_equal(cell, to_array(P.multiply_cell(a, b, (4, 3, 1), (5, 6, 2))))
    with pytest.raises(ValueError):
        BO.multiply_cell(ba, bb, (0, 0, 0), (99, 1, 1))


@pytest.mark.parametrize("mode", ["zero", "mirror_single", "mirror_double"])
@pytest.mark.parametrize("lo,size", [((-9, -30, -1), (31, 70, 5)), ((40, 0, 0), (3, 3, 1)), ((2, 3, 1), (4, 5, 1))])
def test_on_interval(mk, mode, lo, size):
    """Crop, extension and re-blocking at once, also far outside the volume."""
    a = image(6)
    got = BO.on_interval(B.from_voxels(mk(a), (4, 3, 2)), lo, size, (5, 7, 2), mode)
    index = [B._index_map(o, o + s - 1, n, mode) for o, s, n in zip(lo, size, a.shape[::-1])]
    x, y, z = (i >= 0 for i in index)
    want = np.where(z[:, None, None] & y[:, None] & x, a[np.ix_(*reversed(index))], 0)
    assert tuple(got.meta.min) == lo and np.array_equal(to_array(B.to_voxels(got)), want)


def test_only_blocks_in_reach_are_read(mk):
    bv = B.from_voxels(mk(image(7, (1, 40, 40))), (4, 4, 1))
    bv = B.BlockVolume(bv.df.cache(), bv.meta, bv.block)
    plan = BO.on_interval(bv, (9, 30, 0), (3, 3, 1), (4, 4, 1)).df._jdf.queryExecution().optimizedPlan().toString()
    assert "gx" in plan and ">= 2" in plan and "<= 8" in plan


@given(seed=st.integers(0, 50), block=st.tuples(st.integers(1, 7), st.integers(1, 7), st.integers(1, 3)),
       modes=st.tuples(*[st.sampled_from(["zero", "mirror_single", "mirror_double"])] * 3))
@SPARK_SETTINGS
def test_chain_equals_its_operators(mk, seed, block, modes):
    """Borders hold for each intermediate volume, whatever the block size."""
    def run(b):
        b = B.center_gradient(b, 0, modes[0])
        b = BO.convolve_separable(b, [None, [0.5, 0.25, 0.125], [1.0, -0.5]], modes[1])
        return BO.gradient_forward(B.map_pointwise(b, lambda a: a + 1.0), 1, modes[2])
    bv = B.from_voxels(mk(image(seed, (2, 7, 9))), block)
    assert np.array_equal(to_array(B.to_voxels(run(bv.chain()))), to_array(B.to_voxels(run(bv))))


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_chain_is_one_exchange(spark, mk):
    bv = B.from_voxels(mk(image(2, (4, 32, 32))), (8, 8, 2))
    bv = B.BlockVolume(spark.createDataFrame(bv.df.collect(), B.BLOCK_SCHEMA), bv.meta, bv.block)
    run = lambda b: B.gauss(BO.gradient_forward(B.center_gradient(b, 0), 1), (1.0, 1.0, 1.0))
    assert exchanges(run(bv).df) == 3 and exchanges(run(bv.chain()).df) == 1
    assert exchanges(B.gauss(B.retile(bv.chain(), (16, 16, 4)), (1.0,) * 3).df) == 1
    assert exchanges(BO.add(run(bv.chain()), BO.translate(run(bv.chain()), (1, 0, 0))).df) == 1


def test_chain_of_downsamplings(mk):
    """Odd dims and odd blocks: levels inside one exchange equal levels one by one; the type rounds at every level."""
    vol = mk(image(9, (3, 13, 17)))
    c = B.from_voxels(vol, (5, 3, 2)).chain()
    for _ in range(3):
        c, vol = B.downsample2(c), RS.downsample2(vol)
        assert tuple(c.dims) == tuple(vol.dims)
        assert np.array_equal(to_array(B.to_voxels(c)), to_array(vol))


def test_long_chain_is_cut(mk, monkeypatch):
    """A chain whose group would outgrow the bound goes on in a second exchange, with the same result."""
    from tessera.operators import halo
    bv = B.from_voxels(mk(image(3, (1, 20, 20))), (4, 4, 1))
    run = lambda b: B.gauss(B.gauss(B.gauss(b, (2.0, 2.0)), (2.0, 2.0)), (2.0, 2.0))
    want = to_array(B.to_voxels(run(bv)))
    monkeypatch.setattr(halo, "MAX_GROUP_BYTES", 3000)
    out = run(bv.chain())
    assert len(out.stages) < 3 and np.array_equal(to_array(B.to_voxels(out)), want)


def test_frames_are_bounded():
    from tessera.operators.halo import OUT_BYTES, Outbox
    out, frames = Outbox(["k", "payload"]), []
    for k in range(40):
        if out.add((k, b"x" * (OUT_BYTES // 7))):
            frames.append(out.frame())
    assert max(f["payload"].map(len).sum() for f in frames) <= OUT_BYTES * 8 // 7 and sum(map(len, frames)) + len(out.rows) == 40


# ------------------------------------------------------------------ affine

def turned(s):
    t = RS.affine_identity()
    for axis, ang in ((2, 0.4), (1, 0.2), (0, 0.7)):
        t = RS.rotate(t, axis, ang)
    return RS.scale(t, s)


@pytest.mark.parametrize("mode", ["zero", "mirror_single", "mirror_double"])
@pytest.mark.parametrize("s,size", [(0.25, (6, 6, 3)), (1.7, (15, 9, 4)), (1.0, (8, 8, 2))])
def test_affine_on_a_translated_volume(mk, mode, s, size):
    vol = CO.translate(mk(image(4, (6, 12, 12))), (2, -1, 3))
    bv = B.from_voxels(vol, (5, 4, 3))
    want = to_array(RS.affine(vol, turned(s), (-2, 1, 0), size, mode))
    for most in (None, 3000):
        got = B.affine(bv, turned(s), (-2, 1, 0), size, (4, 4, 2), mode, "float64", group_bytes=most)
        assert tuple(got.block) == (4, 4, 2) and tuple(got.meta.min) == (-2, 1, 0)
        assert np.allclose(to_array(B.to_voxels(got)), want, rtol=1e-9, atol=1e-9)


def test_affine_group_is_bounded():
    """Scale 1/16 with a rotation: the source of a part stays below the bound, where a whole block's would not."""
    ti = [[float(v) for v in row] for row in RS.inverse(turned(1 / 16))]
    def reach(block):
        return np.prod([hi - lo + 1 for lo, hi in B._bbox(ti, (0.0,) * 3, block)]) * 8 * 3
    part = B._work_block(ti, (64, 64, 64), 256 << 20)
    assert reach((64, 64, 64)) > 100 * (256 << 20) and reach(part) <= 1.1 * (256 << 20) and min(part) >= 4


def test_affine_sends_fewer_pieces_than_the_bounding_box(spark, mk):
    """Of a rotated target block's bounding box, the corners that no sample needs stay away."""
    bv = B.from_voxels(mk(image(4, (24, 24, 24))), (4, 4, 4))
    t = turned(1.0)
    seen = []
    real = B.grouped_rows
    try:
        B.grouped_rows = lambda df, *rest: (seen.append(df.where("payload IS NOT NULL").count()), real(df, *rest))[1]
        B.affine(bv, t, (0, 0, 0), (24, 24, 24), (12, 12, 12), "zero", "float64")
    finally:
        B.grouped_rows = real
    ti = [[float(v) for v in row] for row in RS.inverse(t)]
    box = 0
    for c in np.ndindex(2, 2, 2):
        n = 1
        for lo, hi in B._bbox(ti, [12.0 * x for x in c], (12.0,) * 3):
            lo, hi = max(lo, 0), min(hi, 23)
            n *= hi // 4 - lo // 4 + 1 if lo <= hi else 0
        box += n
    assert seen[0] < 0.9 * box, (seen, box)


def test_affine_keeps_the_rank(mk):
    bv = B.from_voxels(mk(image(5)), (4, 4, 2))
    out = B.affine(bv, RS.affine_identity(), (0, 0, 1), (6, 6, 1))
    assert out.meta.stored_rank == 3 and out.dims == (6, 6, 1)


# ------------------------------------------------------------------ types

@pytest.mark.parametrize("dtype", ["int8", "int16", "uint32", "uint64", "int64"])
def test_samples_keep_their_type(spark, dtype):
    """Ends of every type survive blocks, identity converters and voxels; floats saturate at the true ends."""
    from tessera.operators import kernels as K
    from tessera.volume import VolumeMeta
    ends = np.iinfo(dtype)
    a = np.array([[[ends.min, ends.max, 1, 0, ends.max - 1, ends.min + 1 if ends.min else 2]]], dtype)
    rows = [(0, 0, 0, 0, 0, 0, 6, 1, 1, bytearray(B.encode(a, dtype)))]
    bv = B.map_pointwise(B.BlockVolume(spark.createDataFrame(rows, B.BLOCK_SCHEMA), VolumeMeta((6, 1, 1), dtype), (6, 1, 1)), lambda x: x)
    vox = B.to_voxels(bv)
    assert [int(r.v) for r in vox.df.orderBy("x").collect()] == a.ravel().tolist()
    back = B.from_voxels(vox, (4, 1, 1))
    assert [int(r.v) for r in B.to_voxels(back).df.orderBy("x").collect()] == a.ravel().tolist()
    assert K.to_dtype(np.array([1e30, -1e30, np.nan, 2.5]), dtype).tolist() == [ends.max, ends.min, 0, 3]


def test_voxel_conversion_equals_block_conversion(spark):
    from pyspark.sql import functions as F

    from tessera.functions.pointwise import to_type
    from tessera.operators import kernels as K
    v = [0.5, -0.5, 2.5, -2.5, 1e30, -1e30, float("nan"), 9.3e18, 1.8446744073709550e19, 126.6, -129.0, 4294967295.5]
    w = [2 ** 60 + 1, -2 ** 63, 2 ** 63 - 1, 300, -5, 0]
    floats = spark.createDataFrame(list(enumerate(v)), "k int, v double")
    longs = spark.createDataFrame(list(enumerate(w)), "k int, v long")
    for dtype in ("uint8", "int8", "int16", "uint16", "uint32", "int32", "uint64", "int64"):
        for df, values, kind in ((floats, v, np.float64), (longs, w, np.int64)):
            got = [int(r.v) for r in df.orderBy("k").select(to_type(F.col("v"), dtype).alias("v")).collect()]
            assert got == K.to_dtype(np.array(values, kind), dtype).tolist(), dtype


def test_affine_of_a_long_mirrored_volume(spark, mk):
    """A source block's mirror images are as many as the target is long; only those that a target reads are looked at."""
    import threading
    vol = mk(np.random.default_rng(3).integers(0, 90, (3, 5, 5000)).astype(np.uint16))
    t = turned(0.9)
    bv = B.from_voxels(vol, (16, 4, 2))
    late = threading.Timer(90, spark.sparkContext.cancelAllJobs)
    late.start()
    try:
        whole = B.affine(bv, t, (0, 0, 0), vol.dims, (16, 4, 2), "mirror_double", "float64")
        got = to_array(B.to_voxels(whole))
    finally:
        late.cancel()
    want = to_array(RS.affine(vol, t, (0, 0, 0), vol.dims, "mirror_double"))
    assert np.allclose(got, want, rtol=1e-9, atol=1e-9)
