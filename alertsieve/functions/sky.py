"""Astrometry columns: Galactic latitude (C2), separation (C3), distances
and the sky-cell keys used by the cell join."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import d

# North Galactic pole, J2000 (degrees).
GAL_POLE_RA = 192.85948
GAL_POLE_DEC = 27.12825


def known(*cols: Column) -> Column:
    """True where every column is neither NULL nor NaN."""
    out = F.lit(True)
    for c in cols:
        out = out & c.isNotNull() & ~F.isnan(c)
    return out


def known_sql(*xs: str) -> str:
    return "(" + " AND ".join(f"{x} IS NOT NULL AND NOT isnan({x})" for x in xs) + ")"


def galactic_lat(ra: Column, dec: Column) -> Column:
    """Galactic latitude b in degrees of (ra, dec) in degrees (C2); NULL when either is
    missing (NULL or NaN)."""
    dp = math.radians(GAL_POLE_DEC)
    r, dd = F.radians(ra), F.radians(dec)
    s = (F.sin(dd) * d(math.sin(dp))
         + F.cos(dd) * d(math.cos(dp)) * F.cos(r - d(math.radians(GAL_POLE_RA))))
    return F.when(known(ra, dec), F.degrees(F.asin(F.least(F.greatest(s, d(-1.0)), d(1.0)))))


def ang_sep(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle separation in radians, haversine form."""
    r1, d1, r2, d2 = F.radians(ra1), F.radians(dec1), F.radians(ra2), F.radians(dec2)
    h = (F.pow(F.sin((d2 - d1) / 2), 2)
         + F.cos(d1) * F.cos(d2) * F.pow(F.sin((r2 - r1) / 2), 2))
    return d(2.0) * F.asin(F.least(d(1.0), F.sqrt(h)))


def ang_dist(dist: Column, z: Column) -> Column:
    """Angular-diameter distance ``dist / (1+z)^2`` (C6); NULL when an input is missing (NULL
    or NaN) or the result is not positive."""
    out = dist / F.nullif(F.pow(d(1.0) + z, 2), d(0.0))
    return F.when(known(dist, z) & (out > 0), out)


def proj_sep_kpc(sep_rad: Column, ang_dist_mpc: Column) -> Column:
    """Projected separation in kpc."""
    return sep_rad * ang_dist_mpc * d(1000.0)


# --- sky cells ---------------------------------------------------------------
# Declination is cut into zones of `cell_deg`; each zone into RA cells of the
# same width.  A cell id is zone * n_ra + ra_cell.

def n_ra_cells(cell_deg: float) -> int:
    return int(math.ceil(360.0 / cell_deg))


def point_cell(ra: Column, dec: Column, cell_deg: float) -> Column:
    """The single cell that holds (ra, dec)."""
    n_ra = n_ra_cells(cell_deg)
    zone = F.floor((F.least(F.greatest(dec, d(-90.0)), d(90.0)) + d(90.0)) / d(cell_deg))
    rac = F.pmod(F.floor(F.pmod(ra, d(360.0)) / d(cell_deg)), F.lit(n_ra))
    return (zone * n_ra + rac).cast("long")


def disc_cells(ra: Column, dec: Column, radius_rad: Column, cell_deg: float) -> Column:
    """Every cell a disc of ``radius_rad`` around (ra, dec) touches (array<long>).

    The RA half-width of a small circle is ``asin(sin r / cos dec)``; a disc that
    holds a pole (or is wider than the sky) covers every RA cell of its zones.
    RA wraps modulo 360.  A relative pad of 1e-9 keeps boundary pairs.
    """
    n_ra = n_ra_cells(cell_deg)
    r_deg = F.degrees(radius_rad) * d(1.0 + 1e-9) + d(1e-12)
    lo_dec = dec - r_deg
    hi_dec = dec + r_deg
    zmin = F.floor((F.greatest(lo_dec, d(-90.0)) + d(90.0)) / d(cell_deg)).cast("long")
    zmax = F.floor((F.least(hi_dec, d(90.0)) + d(90.0)) / d(cell_deg)).cast("long")
    polar = (hi_dec >= d(90.0)) | (lo_dec <= d(-90.0))
    ratio = F.sin(F.radians(r_deg)) / F.cos(F.radians(dec))
    wide = polar | (ratio >= d(1.0))
    half = F.degrees(F.asin(F.least(ratio, d(1.0))))
    cmin = F.when(wide, F.lit(0)).otherwise(F.floor((ra - half) / d(cell_deg))).cast("long")
    cmax = F.when(wide | ((half * 2) >= d(360.0 - cell_deg)), F.lit(n_ra - 1)) \
        .otherwise(F.floor((ra + half) / d(cell_deg))).cast("long")
    zones = F.sequence(zmin, zmax)
    ras = F.array_distinct(F.transform(F.sequence(cmin, cmax), lambda c: F.pmod(c, F.lit(n_ra))))
    return F.flatten(F.transform(zones, lambda z: F.transform(ras, lambda c: z * n_ra + c)))


# --- SQL text forms (one JVM call per expression) ------------------------------

def _fd(x: float) -> str:
    return f"{float(x)!r}D"


def galactic_lat_sql(ra: str, dec: str) -> str:
    dp = math.radians(GAL_POLE_DEC)
    s = (f"SIN(RADIANS({dec})) * {_fd(math.sin(dp))} + COS(RADIANS({dec})) * {_fd(math.cos(dp))} "
         f"* COS(RADIANS({ra}) - {_fd(math.radians(GAL_POLE_RA))})")
    return f"(CASE WHEN {known_sql(ra, dec)} THEN DEGREES(ASIN(least(greatest({s}, -1.0D), 1.0D))) END)"


def ang_sep_sql(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    h = (f"POWER(SIN((RADIANS({dec2}) - RADIANS({dec1})) / 2), 2) + COS(RADIANS({dec1})) * COS(RADIANS({dec2})) "
         f"* POWER(SIN((RADIANS({ra2}) - RADIANS({ra1})) / 2), 2)")
    return f"(2.0D * ASIN(least(1.0D, SQRT({h}))))"


def point_cell_sql(ra: str, dec: str, cell_deg: float) -> str:
    n_ra = n_ra_cells(cell_deg)
    c = _fd(cell_deg)
    return (f"CAST(FLOOR((least(greatest({dec}, -90.0D), 90.0D) + 90.0D) / {c}) * {n_ra} "
            f"+ pmod(FLOOR(pmod({ra}, 360.0D) / {c}), {n_ra}) AS BIGINT)")


def disc_cells_sql(ra: str, dec: str, radius_rad: str, cell_deg: float) -> str:
    """``disc_cells`` as SQL text."""
    n_ra = n_ra_cells(cell_deg)
    c = _fd(cell_deg)
    r = f"(DEGREES({radius_rad}) * 1.000000001D + 1e-12D)"
    lo, hi = f"({dec} - {r})", f"({dec} + {r})"
    polar = f"({hi} >= 90.0D OR {lo} <= -90.0D)"
    ratio = f"(SIN(RADIANS({r})) / COS(RADIANS({dec})))"
    wide = f"({polar} OR {ratio} >= 1.0D)"
    half = f"DEGREES(ASIN(least({ratio}, 1.0D)))"
    zmin = f"CAST(FLOOR((greatest({lo}, -90.0D) + 90.0D) / {c}) AS BIGINT)"
    zmax = f"CAST(FLOOR((least({hi}, 90.0D) + 90.0D) / {c}) AS BIGINT)"
    cmin = f"CAST(CASE WHEN {wide} THEN 0 ELSE FLOOR(({ra} - {half}) / {c}) END AS BIGINT)"
    cmax = (f"CAST(CASE WHEN {wide} OR ({half} * 2) >= {_fd(360.0 - cell_deg)} THEN {n_ra - 1} "
            f"ELSE FLOOR(({ra} + {half}) / {c}) END AS BIGINT)")
    ras = f"array_distinct(transform(sequence({cmin}, {cmax}), x -> pmod(x, {n_ra}L)))"
    return f"flatten(transform(sequence({zmin}, {zmax}), z -> transform({ras}, x -> z * {n_ra} + x)))"
