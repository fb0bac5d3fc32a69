"""Anchors and properties of the scalar functions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylattice.functions import ids, orbits, photometry, sky, times
from skylattice.operators.ephemeris import observer
from skylattice.operators import phase_fit
from skylattice.operators.moid import MoidSolver, with_moid
from skylattice.operators.phase_fit import fit_groups, fit_hg12


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def lits(*xs):
    return tuple(F.lit(float(x)) for x in xs)


def test_photometry_anchors(spark):
    assert value(spark, photometry.njy_to_mag(F.lit(1000.0))) == pytest.approx(23.9, rel=1e-9)
    assert value(spark, photometry.njy_err_to_mag_err(*lits(1000, 10))) == pytest.approx(0.01085736, rel=1e-9)
    assert value(spark, photometry.njy_to_mag(F.lit(-1.0))) is None and value(spark, photometry.njy_err_to_mag_err(*lits(0, 1))) is None
    assert value(spark, photometry.hg_v_mag(*lits(17.52, 0.15, 2.749698608923, 1.88113485538769, 12.8826))) == pytest.approx(21.84628300775939, rel=1e-9)
    for n, deg, want in ((1, 7.5, 0.75), (1, 30, 0.33486016), (1, 45, 0.21415492), (1, 90, 0.05110476), (3, 0, 1), (3, 0.5, 0.71771948), (3, 5, 0.17783991), (3, 31, 0)):
        assert value(spark, photometry.phi(n, F.radians(F.lit(float(deg))))) == pytest.approx(want, abs=1e-8)
    for g, wants in ((0.14, (10, 10.43878164, 10.84254801, 11.86924962)), (0.5, (10, 10.39021354, 10.93181167, 12.08552163))):
        for deg, want in zip((0, 5, 20, 60), wants, strict=True):
            assert value(spark, photometry.hg12(F.radians(F.lit(float(deg))), *lits(10, g))) == pytest.approx(want, abs=1e-8)


def test_columns_and_arrays_agree(spark):
    deg = np.linspace(0, 149.9, 400)
    rows = spark.createDataFrame([(float(d),) for d in deg], "d double").select(*[photometry.phi(n, F.radians("d")) for n in (1, 2, 3)]).collect()
    for n in (1, 2, 3):
        assert np.allclose([r[n - 1] for r in rows], photometry.phi_array(n, np.radians(deg)), atol=1e-12)


def test_sky(spark):
    obj, obs = lits(-2.62664341, -0.82907496, -0.09457145), lits(-0.74729829, -0.63051023, -0.27315426)
    assert value(spark, sky.phase_angle(obj, obs)) == pytest.approx(13.633751950374558, rel=1e-9)
    assert value(spark, sky.separation(*lits(0, 0, 0, 90))) == pytest.approx(90)
    assert value(spark, sky.separation(*lits(359.9999, 0, 0.0001, 0))) == pytest.approx(0.0002, rel=1e-6)
    lon, lat = sky.galactic(*lits(266.4051, -28.936175))
    assert min(value(spark, lon), 360 - value(spark, lon)) < 0.01 and abs(value(spark, lat)) < 0.01
    lon, lat = sky.ecliptic(*lits(0, 0))
    assert value(spark, lon) == 0 and value(spark, lat) == 0
    d_ra, d_dec, total = sky.oc_offsets(*lits(0.001, 10, 359.999, 10))
    assert value(spark, d_ra) == pytest.approx(7.2 * math.cos(math.radians(10)), rel=1e-6) and value(spark, total) == pytest.approx(value(spark, d_ra), rel=1e-3)
    along, across = sky.track_offsets(*lits(3, 4, 0, 2))
    assert (value(spark, along), value(spark, across)) == (4, -3)
    assert value(spark, sky.wrap(F.lit(-11.26))) == pytest.approx(348.74)
    # the Sun stands at right ascension 0 at the March equinox of 2025, and at 90 degrees at the solstice
    for mjd, ra in ((60754.376, 0), (60847.112, 90)):
        got = value(spark, sky.sun_position(F.lit(mjd))[0])
        assert min(abs(got - ra), 360 - abs(got - ra)) < 0.05


def test_times_and_ids(spark):
    assert value(spark, times.mjd_tai_to_utc_micros(F.lit(57754.0 + 37 / 86400))) == (57754 - 40587) * 86_400_000_000
    assert value(spark, times.tai_minus_utc(F.lit(50000.0))) == 29
    for packed, want in (("K08A00B", 4769365062059051808), ("J35M00J", 5345825865851947552), ("~0000", 3472328297535250464)):
        assert value(spark, ids.packed_to_long(F.lit(packed))) == want == int.from_bytes(packed.rjust(8).encode(), "little")
        assert value(spark, ids.long_to_packed(F.lit(want))) == packed
    assert value(spark, ids.packed_to_long(F.lit("ABCDEFGHI"))) == int.from_bytes(b"ABCDEFGH", "little")
    assert value(spark, ids.stripped(F.lit("ab\0\0"))) == "ab"


def test_tisserand(spark):
    for a, e, i, want in ((2.77, 0.08, 10.6, 3.3084472401992464), (1.5, 0.2, 15, 4.485777759949583), (3.463, 0.641, 7.04, 2.745614587882148), (5.2044, 0, 0, 3)):
        assert value(spark, orbits.tisserand_jupiter(*lits(a, e, i))) == pytest.approx(want, rel=1e-12)
    assert value(spark, orbits.semi_major_axis(*lits(1, 1))) is None and value(spark, orbits.tisserand_jupiter(*lits(-2, 1.5, 3))) is None


def test_moid(spark):
    one, two = (1.0, 0.1, 5, 30, 45), (1.5, 0.2, 15, 60, 10)
    for mode in ("multistart", "greedy"):
        got = MoidSolver(mode=mode).solve(one, two)
        assert got[0] == pytest.approx(0.29985650, abs=1e-6) and got[3] == pytest.approx(354.572, abs=0.05) and got[4] == pytest.approx(359.963, abs=0.05)
    earth = (1.00000011, 0.01671022, 0.00005, -11.26064, 102.94719)
    assert MoidSolver().solve(earth, (0.9224, 0.1914, 3.34, 204.45, 126.39))[0] == pytest.approx(0.00111977, abs=1e-6)
    assert MoidSolver().solve((1, 0, 0, 0, 0), (2.5, 0, 0, 0, 0))[0] == pytest.approx(1.5, abs=1e-6)
    assert math.isnan(MoidSolver().solve(one, (-2.0, 1.3, 1, 1, 1))[0])
    rows = spark.createDataFrame([("a", 0.9, 0.3, 3.0, 10.0, 20.0), ("b", 1.0, 1.0, 3.0, 10.0, 20.0), ("c", 1.0, 1.4, 3.0, 10.0, 20.0)], "designation string, q double, e double, i double, node double, argperi double")
    got = {r.designation: r.moid for r in with_moid(rows).collect()}
    assert got["a"] > 0 and got["b"] is None and got["c"] is None


def test_moid_of_many_is_that_of_each():
    rng = np.random.default_rng(4)
    others = np.stack([rng.uniform(0.6, 4, 70), rng.uniform(0, 0.95, 70), rng.uniform(0, 60, 70), rng.uniform(0, 360, 70), rng.uniform(0, 360, 70)], 1)
    others[5, 1], others[6, 0] = 1.2, np.nan
    for mode in ("multistart", "greedy"):
        got = MoidSolver(mode=mode).solve_all((1.0, 0.0167, 0.0, 0.0, 102.9), others)
        assert np.isnan(got[5]).all() and np.isnan(got[6]).all()
        for k in (0, 17, 69):
            assert np.allclose(got[k], MoidSolver(mode=mode).solve((1.0, 0.0167, 0.0, 0.0, 102.9), tuple(others[k])), atol=1e-9)
    fine = np.linspace(0, 2 * np.pi, 721)[:-1]
    for k in range(3):
        r1 = orbits.position(1.0, 0.0167, orbits.axes(0.0, 0.0, 102.9), fine)
        r2 = orbits.position(others[k, 0], others[k, 1], orbits.axes(*others[k, 2:]), fine)
        brute = np.sqrt(((r1[:, None] - r2[None]) ** 2).sum(-1).min())
        assert MoidSolver().solve((1.0, 0.0167, 0.0, 0.0, 102.9), tuple(others[k]))[0] <= brute + 1e-9


@pytest.mark.parametrize("model,g", [("HG12", 0.3), ("HG", 0.15), ("linear", 0.03)])
def test_fits_by_any_model(model, g):
    phase = np.linspace(1, 60, 50)
    mag = phase_fit.MODELS[model](np.radians(phase))(np.full(50, 17.0), np.full(50, g))
    own = phase_fit.MODELS[model]
    for chosen in (model, lambda x: own(x)):
        found = fit_groups(mag, np.full(50, 0.05), phase, np.array([50]), model=chosen)[0]
        assert found[0] == pytest.approx(17, abs=1e-6) and found[1] == pytest.approx(g, abs=1e-6)


def test_fits(spark):
    phase = np.linspace(0, 90, 100)
    basis = [photometry.phi_array(k, np.radians(phase)) for k in (1, 2, 3)]
    for h, g in ((10, 0.14), (18.2, 0.6), (12, 0.19), (12, 0.21)):
        mag = photometry.hg12_array(*basis, np.full(100, float(h)), np.full(100, g))
        found = fit_groups(mag, np.full(100, 0.1), phase, np.array([100]))[0]
        assert found[0] == pytest.approx(h, abs=1e-6) and found[1] == pytest.approx(g, abs=1e-6)
        noisy = fit_groups(mag + np.random.default_rng(42).normal(0, 0.1, 100), np.full(100, 0.1), phase, np.array([100]))[0]
        assert abs(noisy[0] - h) < 3 * noisy[2] and abs(noisy[1] - g) < 3 * noisy[3]
    rows = [("bad", k, 10.0, 0.1, 5.0) for k in range(4)] + [("one", 1, 10.0, 0.1, 5.0), ("two", 1, 10.0, 0.1, 5.0), ("two", 2, 10.5, 0.1, 20.0), ("two", 3, None, 0.1, 20.0), ("two", 4, 10.0, 0.0, 20.0)]
    df = spark.createDataFrame(rows, "o string, n long, m double, s double, p double")
    got = {r.o: r for r in fit_hg12(df, ["o"], F.col("n"), F.col("m"), F.col("s"), F.col("p")).collect()}
    assert got.keys() == {"bad", "two"} and got["two"].n_used == 2 and got["two"].chi2dof is None
    assert got["bad"].H is None and got["bad"].n_used == 0  # one phase can't tell two parameters


def test_two_body_conserves(spark):
    rnd = random.Random(1)
    el = [np.array([rnd.uniform(*r) for _ in range(50)]) for r in ((0.5, 5), (0, 0.9), (0, 90), (0, 360), (0, 360), (0, 360))]
    t = np.linspace(60000, 61000, 50)
    r, v = orbits.two_body(*el, np.full(50, 60000.0), t)
    energy = (v**2).sum(1) / 2 - orbits.GAUSS_K**2 / np.linalg.norm(r, axis=1)
    assert np.allclose(energy, -(orbits.GAUSS_K**2) / (2 * el[0]), rtol=1e-9)
    r, v = orbits.earth(np.array([60000.0, 60100.0]))
    assert np.allclose(np.linalg.norm(r, axis=1), 1, atol=0.02)
    place, _ = observer(np.array([60000.0]), 289.25, 0.86, -0.5)
    assert 3e-5 < np.linalg.norm(place - r[:1]) < 5e-5
    # Earth's direction is opposite to the Sun's
    sun = -r[0] / np.linalg.norm(r[0])
    ra, dec = (value(spark, c) for c in sky.sun_position(F.lit(60000.0)))
    assert math.degrees(math.acos(np.clip(sun @ [math.cos(math.radians(dec)) * math.cos(math.radians(ra)), math.cos(math.radians(dec)) * math.sin(math.radians(ra)), math.sin(math.radians(dec))], -1, 1))) < 0.5
