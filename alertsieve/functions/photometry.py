"""Photometry columns: DC magnitude (C1), absolute magnitude (C4), rates (A4, A5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import d, num


def _flux(mag: Column, zp: Column) -> Column:
    return F.pow(d(10.0), d(-0.4) * (mag - zp))


def dc_mag(fid: Column, magpsf: Column, sigmapsf: Column, magnr: Column,
           sigmagnr: Column, magzpsci: Column, isdiffpos: Column) -> Column:
    """Apparent (difference + reference) magnitude as ``struct(mag, err)``.

    Our definition (the reference calls an external helper): with one zero
    point ``zp = magzpsci``,
    ``f_ref = 10^(-0.4 (magnr - zp))``, ``f_dif = 10^(-0.4 (magpsf - zp))``,
    ``f = f_ref + f_dif`` for a positive subtraction (``t``/``1``) and
    ``f_ref - f_dif`` otherwise, ``mag = zp - 2.5 log10 f`` and
    ``err = sqrt((sigmagnr f_ref)^2 + (sigmapsf f_dif)^2) / f``.
    Missing input or a non-positive total flux gives NULL.  ``fid`` is kept in
    the signature for a per-band reference zero point.
    """
    zp = num(magzpsci)
    f_ref = _flux(num(magnr), zp)
    f_dif = _flux(num(magpsf), zp)
    positive = isdiffpos.isin("t", "1")
    f = F.when(positive, f_ref + f_dif).when(isdiffpos.isNotNull(), f_ref - f_dif)
    ok = f > 0
    mag = F.when(ok, zp - d(2.5) * F.log10(f))
    err = F.when(ok, F.sqrt(F.pow(num(sigmagnr) * f_ref, 2) + F.pow(num(sigmapsf) * f_dif, 2)) / f)
    return F.struct(mag.alias("mag"), err.alias("err"))


def dc_mag_of(p: Column) -> Column:
    """``dc_mag`` of a light-curve point struct."""
    return dc_mag(p["fid"], p["magpsf"], p["sigmapsf"], p["magnr"], p["sigmagnr"],
                  p["magzpsci"], p["isdiffpos"])


def abs_mag(mag: Column, lum_dist_mpc: Column) -> Column:
    """``mag - 25 - 5 log10(lum_dist[Mpc])`` (C4)."""
    return mag - d(25.0) - d(5.0) * F.log10(lum_dist_mpc)


def two_point_rate(pts: Column) -> Column:
    """Rate between the last two points of ``pts`` (array of struct(jd, mag, err)).

    ``rate = (m[-1]-m[-2]) / (t[-1]-t[-2])``, ``rate_err = sqrt(e1^2+e2^2)/dt``;
    NULL when fewer than two points or ``dt = 0`` (A5).
    """
    last = F.try_element_at(pts, F.lit(-1))
    prev = F.try_element_at(pts, F.lit(-2))
    dt = F.nullif(last["jd"] - prev["jd"], d(0.0))
    return F.struct(
        ((last["mag"] - prev["mag"]) / dt).alias("rate"),
        (F.sqrt(F.pow(last["err"], 2) + F.pow(prev["err"], 2)) / dt).alias("rate_err"),
    )


def weighted_fit(pts: Column, max_mag: float = 99.0, min_span: float = 0.0) -> Column:
    """A4: weighted straight-line fit ``mag = a jd + b`` over ``pts``
    (array of struct(jd, mag, err)) in one pass; see ``lightcurve.fold_rate``
    for the returned struct (slope, slope_var, n_fit, span, ok, ...)."""
    from .lightcurve import fold_rate
    return fold_rate(pts, max_mag, min_span)


def dc_mag_sql(prefix: str = "") -> str:
    """``dc_mag`` of the columns ``{prefix}magpsf`` ... as SQL text: struct(jd, mag, err)."""
    from .lightcurve import with_dc_sql
    pt = (f"named_struct('jd', CAST(NULL AS DOUBLE), 'magpsf', {prefix}magpsf, 'sigmapsf', {prefix}sigmapsf, "
          f"'magnr', {prefix}magnr, 'sigmagnr', {prefix}sigmagnr, 'magzpsci', {prefix}magzpsci, "
          f"'isdiffpos', {prefix}isdiffpos)")
    return f"element_at({with_dc_sql('array(' + pt + ')')}, 1)"
