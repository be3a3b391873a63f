"""Time and text columns for notification rows.

All of them are deterministic and independent of the session time zone: the
calendar date comes from ``date_from_unix_date`` and the clock from integer
arithmetic on milliseconds.  A missing input (NULL or NaN) gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S
from .columns import d
from .sky import known, known_sql

JD_UNIX_EPOCH = 2440587.5

# Default link templates (base URLs are parameters).
PORTAL_BASE = "https://alerts.example.org/"
TNS_SEARCH = "https://www.wis-tns.org/search?ra=%.7f&decl=%.7f&radius=5&coords_unit=arcsec"


def jd_to_unix_ms(jd: Column) -> Column:
    return F.round((jd - d(JD_UNIX_EPOCH)) * d(86400000.0)).cast("long")


def jd_to_utc(jd: Column) -> Column:
    """JD -> 'YYYY-MM-DD HH:MM:SS.mmm' UTC (rounded to the millisecond)."""
    ms = jd_to_unix_ms(F.when(known(jd), jd))
    day = F.floor(ms / F.lit(86400000)).cast("long")
    rem = ms - day * 86400000
    return F.when(known(jd), F.format_string(
        "%s %02d:%02d:%02d.%03d",
        F.date_from_unix_date(day.cast("int")).cast("string"),
        (rem / 3600000).cast("long"), ((rem / 60000).cast("long") % 60),
        ((rem / 1000).cast("long") % 60), rem % 1000))


def ra_hms(ra_deg: Column) -> Column:
    """RA in hours as 'H MM SS.ss' (rounded in the last unit first, so 59.995 s
    carries into the minute)."""
    cs = F.round(F.when(known(ra_deg), ra_deg) / d(15.0) * d(360000.0)).cast("long")   # centiseconds of time
    return F.when(known(ra_deg), F.format_string("%d %02d %05.2f", (cs / 360000).cast("long"),
                                                 ((cs / 6000).cast("long") % 60), (cs % 6000) / d(100.0)))


def dec_dms(dec_deg: Column) -> Column:
    """Declination as '+D MM SS.s' with explicit sign, carry-safe."""
    ds = F.round(F.abs(F.when(known(dec_deg), dec_deg)) * d(36000.0)).cast("long")     # deci-arcseconds
    sign = F.when(dec_deg < 0, F.lit("-")).otherwise(F.lit("+"))
    return F.when(known(dec_deg), F.format_string("%s%d %02d %04.1f", sign, (ds / 36000).cast("long"),
                                                  ((ds / 600).cast("long") % 60), (ds % 600) / d(10.0)))


def band_name(fid: Column) -> Column:
    """1 -> 'g', 2 -> 'r', other ids -> NULL."""
    expr = None
    for k, v in S.BAND_NAMES.items():
        expr = F.when(fid == k, F.lit(v)) if expr is None else expr.when(fid == k, F.lit(v))
    return expr


def is_friday(as_of_date: Column) -> Column:
    """C14: ISO weekday 5.  ``as_of_date`` is passed in (the reference reads the
    wall clock, which makes results depend on the day they are computed)."""
    return F.dayofweek(as_of_date) == 6


def portal_link(object_id: Column, base: str = PORTAL_BASE) -> Column:
    """C15."""
    return F.concat(F.lit(base), object_id)


def tns_link(ra: Column, dec: Column, template: str = TNS_SEARCH) -> Column:
    """Transient-name-server cone search around (ra, dec)."""
    return F.when(known(ra, dec), F.format_string(template, ra, dec))


def fmt_fixed(x: Column, decimals: int, signed: bool = False) -> Column:
    """Fixed-decimal text, e.g. '{:.2f}' / '{:+.7f}'."""
    return F.when(known(x), F.format_string(("%+." if signed else "%.") + f"{decimals}f", x))


def strip_bytes_repr(name: Column) -> Column:
    """C17: "b'NGC 1234'" -> 'NGC 1234' (drop first two and the last character)."""
    return name.substr(F.lit(3), F.length(name) - 3)


# --- SQL text forms (one JVM call each; same arithmetic as above) ----------------

def _if_known(text: str, *xs: str) -> str:
    return f"(CASE WHEN {known_sql(*xs)} THEN {text} END)"


def jd_to_utc_sql(jd: str) -> str:
    ms = f"CAST(round(({jd} - {JD_UNIX_EPOCH!r}D) * 86400000.0D) AS BIGINT)"
    day = f"CAST(floor({ms} / 86400000) AS BIGINT)"
    rem = f"({ms} - {day} * 86400000)"
    return _if_known(
        f"format_string('%s %02d:%02d:%02d.%03d', CAST(date_from_unix_date(CAST({day} AS INT)) AS STRING), "
        f"CAST({rem} / 3600000 AS BIGINT), CAST({rem} / 60000 AS BIGINT) % 60, "
        f"CAST({rem} / 1000 AS BIGINT) % 60, {rem} % 1000)", jd)


def ra_hms_sql(ra: str) -> str:
    cs = f"CAST(round({ra} / 15.0D * 360000.0D) AS BIGINT)"
    return _if_known(f"format_string('%d %02d %05.2f', CAST({cs} / 360000 AS BIGINT), "
                     f"CAST({cs} / 6000 AS BIGINT) % 60, ({cs} % 6000) / 100.0D)", ra)


def dec_dms_sql(dec: str) -> str:
    ds = f"CAST(round(abs({dec}) * 36000.0D) AS BIGINT)"
    return _if_known(f"format_string('%s%d %02d %04.1f', CASE WHEN {dec} < 0 THEN '-' ELSE '+' END, "
                     f"CAST({ds} / 36000 AS BIGINT), CAST({ds} / 600 AS BIGINT) % 60, ({ds} % 600) / 10.0D)", dec)


def fmt_fixed_sql(x: str, decimals: int, signed: bool = False) -> str:
    return _if_known(f"format_string('{'%+.' if signed else '%.'}{decimals}f', {x})", x)


def message_sql(template: str, *xs: str) -> str:
    """A message field; NULL when a number in it is missing."""
    return _if_known(f"format_string('{template}', {', '.join(xs)})", *xs)


def portal_link_sql(object_id: str, base: str = PORTAL_BASE) -> str:
    return f"concat('{base}', {object_id})"


def band_name_sql(fid: str) -> str:
    return "CASE " + " ".join(f"WHEN {fid} = {k} THEN '{v}'" for k, v in S.BAND_NAMES.items()) + " END"


def tns_link_sql(ra: str, dec: str, template: str = TNS_SEARCH) -> str:
    return _if_known(f"format_string('{template}', {ra}, {dec})", ra, dec)
