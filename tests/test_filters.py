"""Gradients, tubeness, Gaussian, downsampling and affine against closed cases and numpy."""

import numpy as np
import pytest

from tessera.operators import blocks as B
from tessera.operators import convolve as CV
from tessera.operators import resample as RS
from tessera.operators import stencil as ST

from conftest import to_array


@pytest.fixture(scope="module")
def ramp():
    z, y, x = np.meshgrid(np.arange(5), np.arange(7), np.arange(9), indexing="ij")
    return (3 * x + 5 * y + 7 * z).astype(np.int64)  # S1


def test_gradient_of_ramp(mk, ramp):
    vol = mk(ramp, "int64")
    for axis, slope in enumerate((3, 5, 7)):
        g = to_array(ST.center_gradient(vol, axis, "mirror_single", dense=True))
        sl = [slice(1, -1)] * 3
        assert (g[tuple(sl)] == slope).all()
        first = [slice(None)] * 3
        first[2 - axis] = 0
        last = [slice(None)] * 3
        last[2 - axis] = -1
        assert (g[tuple(first)] == 0).all() and (g[tuple(last)] == 0).all()  # zero at mirrored ends
    fwd = to_array(ST.gradient_forward(vol, 0, "mirror_double", dense=True))
    assert (fwd[:, :, :-1] == 3).all() and (fwd[:, :, -1] == 0).all()


def test_tubeness_rule():
    ev = np.array([[0.0, -2, -2], [0, 2, 2], [1, 3, -4], [0.5, -1, -3]])
    got = ST.tubeness_values(ev)
    assert np.allclose(got[:3], [1.0, -1.0, 0.0])
    assert np.isclose(got[3], np.sqrt(3 * (1 - 0.5)) / 3)


def test_tubeness_sign_on_line(mk):
    a = np.zeros((16, 16, 16))
    a[8, 8, :] = 1000.0  # bright line along x (S4)
    vol = mk(a, "float64")
    t = to_array(ST.tubeness(vol, (1.0, 1.0, 1.0), "zero", dense=True))
    neg = to_array(ST.tubeness(mk(-a, "float64"), (1.0, 1.0, 1.0), "zero", dense=True))
    assert t[8, 8, 4:12].min() > 0 and neg[8, 8, 4:12].max() < 0


def test_gauss_impulse_is_kernel_outer_product(mk):
    a = np.zeros((15, 15))
    a[7, 7] = 1.0  # S3 (one slice)
    h = CV.gauss_half_kernel(2.0)
    full = np.concatenate([h[:0:-1], h])
    assert abs(full.sum() - 1.0) < 1e-12
    got = to_array(CV.gauss(mk(a, "float64"), (2.0, 2.0, 0.0), "zero", dense=True))[0]
    want = np.zeros((15, 15))
    k = len(h) - 1
    want[7 - k:7 + k + 1, 7 - k:7 + k + 1] = np.outer(full, full)
    assert np.allclose(got, want, atol=1e-15)


@pytest.mark.parametrize("block", [(4, 4, 1), (15, 15, 1)])
def test_dog_block_equals_voxel(mk, block):
    rng = np.random.default_rng(3)
    a = rng.random((15, 15)).astype(np.float32) * 1000
    vol = mk(a, "float32")
    want = to_array(CV.dog(vol, (4.0, 4.0, 0.0), (3.0, 3.0, 0.0), "mirror_single", dense=True))
    got = to_array(B.to_voxels(B.dog(B.from_voxels(vol, block), (4.0, 4.0, 0.0), (3.0, 3.0, 0.0))))
    assert np.array_equal(got, want)


def test_downsample_odd_sizes(mk):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 100, size=(3, 5, 7)).astype(np.int64)
    out = to_array(RS.downsample2(mk(a, "int64"), "float64"))
    p = np.pad(a.astype(float), [(0, 1), (0, 1), (0, 1)], mode="edge")  # mirror-double at the odd end
    want = p.reshape(2, 2, 3, 2, 4, 2).mean(axis=(1, 3, 5))
    assert out.shape == (2, 3, 4) and np.allclose(out, want)
    assert RS.downsampled_dims((7, 5, 1)) == (4, 3, 1)


def test_affine_identity_and_translation(mk):
    rng = np.random.default_rng(2)
    a = rng.integers(0, 255, size=(9, 11)).astype(np.int64)
    vol = mk(a, "int64")
    ident = to_array(RS.affine(vol, RS.affine_identity(), (0, 0, 0), vol.dims, "zero"))[0]
    assert np.allclose(ident, a)
    t = RS.affine_identity()
    t[0, 3] = 0.5  # half-pixel shift: mean of neighbours
    sh = to_array(RS.affine(vol, t, (0, 0, 0), vol.dims, "mirror_double"))[0]
    assert np.allclose(sh[:, 1:], (a[:, 1:] + a[:, :-1]) / 2)


@pytest.mark.parametrize("extension", ["mirror_double", "zero"])
def test_affine_3d_block_form_equals_voxel_form(mk, extension):
    rng = np.random.default_rng(4)
    a = rng.integers(0, 65535, size=(5, 7, 9)).astype(np.uint16)
    vol = mk(a)
    t = RS.affine_identity()
    for axis, ang in ((2, 0.3), (1, 0.1), (0, 0.6)):
        t = RS.rotate(t, axis, ang)
    t = RS.scale(t, 0.9)
    want = to_array(RS.affine(vol, t, (0, 0, 0), (9, 7, 5), extension, "uint16"))
    got = to_array(B.to_voxels(B.affine(B.from_voxels(vol, (4, 3, 2)), t, (0, 0, 0), (9, 7, 5), (3, 4, 2),
                                        extension, "uint16")))
    assert np.array_equal(got, want)
