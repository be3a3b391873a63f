"""Light-curve operators (L1-L15) over ``lc``: history ++ current measurement.

``lc`` is ``array<struct<jd, fid, magpsf, sigmapsf, magnr, sigmagnr, magzpsci,
isdiffpos, ssnamenr>>``, oldest first, last element = current measurement.
All operators are higher-order array functions: they run per row inside
whole-stage code generation, need no shuffle and work the same in a stream.
Indexing uses ``get``/``try_element_at`` so that ANSI mode never raises on
short histories (a ``CASE``/``AND`` guard does not stop ANSI errors).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import HISTORY_POINT
from .columns import d, flag
from .photometry import dc_mag_of

LC_FIELDS = HISTORY_POINT.fieldNames()


def current_point(df: DataFrame, struct: str = "candidate") -> Column:
    cand = F.col(struct)
    return F.struct(*[cand[f].cast(HISTORY_POINT[f].dataType).alias(f) for f in LC_FIELDS])


def lc_concat(df: DataFrame, history: str = "prv_candidates", struct: str = "candidate") -> Column:
    """L1: ``history ++ [current]``; a missing history is an empty one."""
    hist = F.transform(
        F.coalesce(F.col(history), F.array()),
        lambda p: F.struct(*[p[f].cast(HISTORY_POINT[f].dataType).alias(f) for f in LC_FIELDS]),
    )
    return F.concat(hist, F.array(current_point(df, struct)))


def lc_field(lc: Column, field: str) -> Column:
    """Parallel array of one field (the reference's ``c<field>c`` columns)."""
    return F.transform(lc, lambda p: p[field])


def lc_last(lc: Column) -> Column:
    """L2: newest point (NULL for an empty array)."""
    return F.try_element_at(lc, F.lit(-1))


def is_valid(p: Column) -> Column:
    return p["magpsf"].isNotNull() & ~F.isnan(p["magpsf"])


def lc_valid(lc: Column) -> Column:
    """L3: points with a magnitude (detections)."""
    return F.filter(lc, is_valid)


def lc_same_band(lc: Column, last_fid: Column | None = None) -> Column:
    """L4: valid points in the band of the newest point.

    Pass ``last_fid`` (the current measurement's band, e.g. ``candidate.fid``)
    when ``lc`` is an expression rather than a column: the lambda would
    otherwise rebuild ``lc`` for every element."""
    last_fid = last_fid if last_fid is not None else lc_last(lc)["fid"]
    return F.filter(lc, lambda p: is_valid(p) & (p["fid"] == last_fid))


def lc_tail2(a: Column) -> Column:
    """Last two entries; NULL when fewer than two."""
    return F.when(F.size(a) >= 2, F.slice(a, -2, 2))


def with_dc(a: Column) -> Column:
    """Array of struct(jd, mag, err) with the DC magnitude of each point."""
    with_struct = F.transform(a, lambda p: F.struct(p["jd"].alias("jd"), dc_mag_of(p).alias("dc")))
    return F.transform(with_struct, lambda q: F.struct(
        q["jd"].alias("jd"), q["dc"]["mag"].alias("mag"), q["dc"]["err"].alias("err")))


def lc_outlier_cut(dc_points: Column, max_mag: float = 21.0) -> Column:
    """Keep DC points brighter than ``max_mag`` (NULL magnitudes dropped)."""
    return F.filter(dc_points, lambda p: p["mag"] < d(max_mag))


def lc_span(a: Column) -> Column:
    """Last jd - first jd (NULL for an empty array)."""
    return F.try_element_at(a, F.lit(-1))["jd"] - F.try_element_at(a, F.lit(1))["jd"]


def days_since_last(lc: Column) -> Column:
    """Jd of the last valid point minus the previous valid point, any band;
    NULL with fewer than two valid points."""
    v = lc_valid(lc)
    return F.try_element_at(v, F.lit(-1))["jd"] - F.try_element_at(v, F.lit(-2))["jd"]


def days_since_first(jd: Column, jdstarthist: Column) -> Column:
    """L9."""
    return jd.cast("double") - jdstarthist.cast("double")


def lc_all_faint(v: Column, limit: float = 18.0) -> Column:
    """Every valid magnitude fainter than ``limit`` (true when none)."""
    return F.forall(v, lambda p: p["magpsf"] > d(limit))


def lc_exactly(v: Column, n: int = 3) -> Column:
    """L11."""
    return F.size(v) == n


def lc_span3(v: Column, max_days: float = 10.0) -> Column:
    """With exactly three valid points, jd[2] - jd[0] < max_days."""
    return flag(lc_exactly(v, 3) & ((F.get(v, 2)["jd"] - F.get(v, 0)["jd"]) < d(max_days)))


def valid_rate(v: Column) -> Column:
    """Rate test on the 2nd and 3rd valid points (exactly three points).

    same band -> m3 - m2 > 0; band id rising (g then r) -> m2 - m3 <= 0.3;
    otherwise m3 - m2 > 0.
    """
    p2, p3 = F.get(v, 1), F.get(v, 2)
    cond = (F.when(p2["fid"] == p3["fid"], (p3["magpsf"] - p2["magpsf"]) > 0)
            .when(p3["fid"] > p2["fid"], (p2["magpsf"] - p3["magpsf"]) <= d(0.3))
            .otherwise((p3["magpsf"] - p2["magpsf"]) > 0))
    return flag(lc_exactly(v, 3) & cond)


def band_mean(v: Column, fid: int) -> Column:
    """Mean valid magnitude in band ``fid``; NULL when the band is empty."""
    pts = F.filter(v, lambda p: p["fid"].cast("long") == fid)
    total = F.aggregate(pts, d(0.0), lambda acc, p: acc + p["magpsf"])
    return F.when(F.size(pts) > 0, total / F.size(pts))


def band_mean_color(v: Column) -> Column:
    """Mean g - mean r >= 0; a missing band fails."""
    return flag((band_mean(v, 1) - band_mean(v, 2)) >= 0)


def lc_no_known_sso(v: Column) -> Column:
    """No valid point carries a solar-system object name."""
    return F.forall(v, lambda p: F.coalesce(p["ssnamenr"], F.lit("null")) == "null")


# ---------------------------------------------------------------------------
# single-pass folds: every statistic a filter needs from one array in one
# `aggregate`, so the (possibly inlined) array expression is referenced once.
# Catalyst inlines projections into pushed-down filters; an array referenced
# k times would then be rebuilt k times per row.
# ---------------------------------------------------------------------------

def _null_d() -> Column:
    return F.lit(None).cast("double")


def days_since_last_fold(lc: Column) -> Column:
    """L8 as a single pass: NULL with fewer than two valid points."""
    return F.aggregate(
        lc, F.struct(_null_d().alias("prev_jd"), _null_d().alias("last_jd")),
        lambda acc, p: F.when(is_valid(p), F.struct(acc["last_jd"].alias("prev_jd"),
                                                    p["jd"].alias("last_jd"))).otherwise(acc),
        lambda acc: acc["last_jd"] - acc["prev_jd"])


def fold_orphan(lc: Column) -> Column:
    """All light-curve terms of the orphan-GRB filter (L10-L15) in one pass.

    Returns struct(n_valid, all_faint, exactly3, span3, valid_rate, color_ok,
    no_known_sso); the 1st/2nd/3rd valid points are captured while counting.
    """
    zero_l = F.lit(0).cast("long")
    pt_null = F.lit(None).cast("struct<jd:double,fid:bigint,mag:double>")
    init = F.struct(zero_l.alias("n"), zero_l.alias("n_bright"), pt_null.alias("v0"), pt_null.alias("v1"),
                    pt_null.alias("v2"), d(0.0).alias("sg"), zero_l.alias("ng"), d(0.0).alias("sr"),
                    zero_l.alias("nr"), zero_l.alias("n_sso"))

    def merge(acc, p):
        me = F.struct(p["jd"].alias("jd"), p["fid"].cast("long").alias("fid"), p["magpsf"].alias("mag"))
        g = p["fid"].cast("long") == 1
        r = p["fid"].cast("long") == 2
        upd = F.struct(
            (acc["n"] + 1).alias("n"),
            (acc["n_bright"] + F.when(~(p["magpsf"] > d(18.0)), 1).otherwise(0)).alias("n_bright"),
            F.when(acc["n"] == 0, me).otherwise(acc["v0"]).alias("v0"),
            F.when(acc["n"] == 1, me).otherwise(acc["v1"]).alias("v1"),
            F.when(acc["n"] == 2, me).otherwise(acc["v2"]).alias("v2"),
            (acc["sg"] + F.when(g, p["magpsf"]).otherwise(d(0.0))).alias("sg"),
            (acc["ng"] + F.when(g, 1).otherwise(0)).alias("ng"),
            (acc["sr"] + F.when(r, p["magpsf"]).otherwise(d(0.0))).alias("sr"),
            (acc["nr"] + F.when(r, 1).otherwise(0)).alias("nr"),
            (acc["n_sso"] + F.when(F.coalesce(p["ssnamenr"], F.lit("null")) != "null", 1).otherwise(0))
            .alias("n_sso"),
        )
        return F.when(is_valid(p), upd).otherwise(acc)

    def finish(acc):
        three = acc["n"] == 3
        v0, v1, v2 = acc["v0"], acc["v1"], acc["v2"]
        rate = (F.when(v1["fid"] == v2["fid"], (v2["mag"] - v1["mag"]) > 0)
                .when(v2["fid"] > v1["fid"], (v1["mag"] - v2["mag"]) <= d(0.3))
                .otherwise((v2["mag"] - v1["mag"]) > 0))
        mean_g = F.when(acc["ng"] > 0, acc["sg"] / acc["ng"])
        mean_r = F.when(acc["nr"] > 0, acc["sr"] / acc["nr"])
        return F.struct(
            acc["n"].alias("n_valid"),
            (acc["n_bright"] == 0).alias("all_faint"),
            three.alias("exactly3"),
            flag(three & ((v2["jd"] - v0["jd"]) < d(10.0))).alias("span3"),
            flag(three & rate).alias("valid_rate"),
            flag((mean_g - mean_r) >= 0).alias("color_ok"),
            (acc["n_sso"] == 0).alias("no_known_sso"),
            mean_g.alias("mean_g"), mean_r.alias("mean_r"),
        )

    return F.aggregate(lc, init, merge, finish)


def fold_rate(dc_pts: Column, max_mag: float = 21.0, min_span: float = 0.5) -> Column:
    """Rate statistics over same-band DC points (struct(jd, mag, err)) in one pass.

    Points brighter than ``max_mag`` with a positive error enter a weighted
    straight-line fit (A4; weights 1/err^2, x and y centred on the first kept
    point); a point without an error, or with error 0, has no weight and is
    left out of the fit, its count and its span.  Returns
    struct(n_points, n_fit, span, ok, slope, slope_var, last_mag, last_err):
    ``ok`` = at least two kept points spanning more than ``min_span`` days;
    ``slope_var`` is the slope variance scaled by chi2/(n-2) (NULL for n <= 2);
    ``last_*`` is the newest point whatever its magnitude.
    """
    zero = d(0.0)
    zl = F.lit(0).cast("long")
    init = F.struct(zl.alias("np"), zl.alias("n"), _null_d().alias("x0"), _null_d().alias("y0"),
                    _null_d().alias("x_last"), zero.alias("sw"), zero.alias("sx"), zero.alias("sy"),
                    zero.alias("sxx"), zero.alias("sxy"), zero.alias("syy"),
                    _null_d().alias("last_mag"), _null_d().alias("last_err"))

    def merge(acc, q):
        keep = (q["mag"] < d(max_mag)) & (q["err"] > 0) & ~F.isnan(q["err"])
        x0 = F.coalesce(acc["x0"], q["jd"])
        y0 = F.coalesce(acc["y0"], q["mag"])
        w = d(1.0) / F.nullif(F.pow(q["err"], 2), d(0.0))
        x = q["jd"] - x0
        y = q["mag"] - y0
        fit = F.struct(
            (acc["np"] + 1).alias("np"), (acc["n"] + 1).alias("n"), x0.alias("x0"), y0.alias("y0"),
            q["jd"].alias("x_last"),
            (acc["sw"] + w).alias("sw"), (acc["sx"] + w * x).alias("sx"), (acc["sy"] + w * y).alias("sy"),
            (acc["sxx"] + w * x * x).alias("sxx"), (acc["sxy"] + w * x * y).alias("sxy"),
            (acc["syy"] + w * y * y).alias("syy"),
            q["mag"].alias("last_mag"), q["err"].alias("last_err"))
        skip = acc.withField("np", acc["np"] + 1).withField("last_mag", q["mag"]) \
                  .withField("last_err", q["err"])
        return F.when(flag(keep), fit).otherwise(skip)

    def finish(acc):
        den = F.nullif(acc["sw"] * acc["sxx"] - acc["sx"] * acc["sx"], zero)
        slope = (acc["sw"] * acc["sxy"] - acc["sx"] * acc["sy"]) / den
        icpt = (acc["sy"] - slope * acc["sx"]) / acc["sw"]
        chi2 = acc["syy"] - slope * acc["sxy"] - icpt * acc["sy"]
        span = acc["x_last"] - acc["x0"]
        ok = flag((acc["n"] >= 2) & (span > d(min_span)))
        return F.struct(
            acc["np"].alias("n_points"), acc["n"].alias("n_fit"), span.alias("span"), ok.alias("ok"),
            F.when(ok, slope).alias("slope"),
            F.when(ok & (acc["n"] > 2), acc["sw"] / den * F.greatest(chi2, zero) / (acc["n"] - 2))
            .alias("slope_var"),
            acc["last_mag"].alias("last_mag"), acc["last_err"].alias("last_err"))

    return F.aggregate(dc_pts, init, merge, finish)


# ---------------------------------------------------------------------------
# Spark SQL text forms.  Building a lambda-rich Column node by node costs one
# JVM round trip per node; the same expression as SQL text is one call.  The
# hot paths (filters, fits) use these; the Column functions above remain the
# composable API.  Semantics and operation order are identical.
# ---------------------------------------------------------------------------

_CASTS = {"jd": "DOUBLE", "fid": "BIGINT", "magpsf": "DOUBLE", "sigmapsf": "DOUBLE", "magnr": "DOUBLE",
          "sigmagnr": "DOUBLE", "magzpsci": "DOUBLE", "isdiffpos": "STRING", "ssnamenr": "STRING"}


#: Columns of one measurement.
POINT_NAMES = list(_CASTS)


def _point_sql(src: str) -> str:
    return "named_struct(" + ", ".join(f"'{f}', CAST({src}.{f} AS {t})" for f, t in _CASTS.items()) + ")"


def lc_concat_sql(history: str = "prv_candidates", struct: str = "candidate") -> str:
    """L1 as SQL text."""
    return (f"concat(transform(coalesce({history}, array()), p -> {_point_sql('p')}), "
            f"array({_point_sql(struct)}))")


def valid_sql(p: str = "p") -> str:
    return f"({p}.magpsf IS NOT NULL AND NOT isnan({p}.magpsf))"


def n_valid_sql(history: str = "prv_candidates", struct: str = "candidate") -> str:
    """Number of valid points of history and current measurement, without building the light curve (SQL text)."""
    valid = "CAST({p}.magpsf AS DOUBLE) IS NOT NULL AND NOT isnan(CAST({p}.magpsf AS DOUBLE))"
    return (f"(size(filter(coalesce({history}, array()), p -> {valid.format(p='p')})) "
            f"+ CASE WHEN {valid.format(p=struct)} THEN 1 ELSE 0 END)")


def same_band_sql(lc: str, last_fid: str) -> str:
    """L4 as SQL text (``last_fid``: the current measurement's band)."""
    return f"filter({lc}, p -> {valid_sql('p')} AND p.fid = {last_fid})"


def with_dc_sql(a: str) -> str:
    """Points -> struct(jd, mag, err) with the DC magnitude (same algebra as ``dc_mag``)."""
    fluxes = (f"transform({a}, p -> named_struct("
              "'jd', p.jd, "
              "'zp', nanvl(p.magzpsci, CAST(NULL AS DOUBLE)), "
              "'fr', POWER(10.0D, -0.4D * (nanvl(p.magnr, CAST(NULL AS DOUBLE)) - nanvl(p.magzpsci, CAST(NULL AS DOUBLE)))), "
              "'fd', POWER(10.0D, -0.4D * (nanvl(p.magpsf, CAST(NULL AS DOUBLE)) - nanvl(p.magzpsci, CAST(NULL AS DOUBLE)))), "
              "'sr', nanvl(p.sigmagnr, CAST(NULL AS DOUBLE)), "
              "'sp', nanvl(p.sigmapsf, CAST(NULL AS DOUBLE)), "
              "'pos', p.isdiffpos IN ('t', '1'), 'known', p.isdiffpos IS NOT NULL))")
    total = ("transform(" + fluxes + ", q -> named_struct('jd', q.jd, 'zp', q.zp, 'fr', q.fr, 'fd', q.fd, "
             "'sr', q.sr, 'sp', q.sp, 'f', CASE WHEN q.pos THEN q.fr + q.fd WHEN q.known THEN q.fr - q.fd END))")
    return ("transform(" + total + ", q -> named_struct('jd', q.jd, "
            "'mag', CASE WHEN q.f > 0 THEN q.zp - 2.5D * LOG10(q.f) END, "
            "'err', CASE WHEN q.f > 0 THEN SQRT(POWER(q.sr * q.fr, 2) + POWER(q.sp * q.fd, 2)) / q.f END))")


def days_since_last_sql(lc: str) -> str:
    """L8 as SQL text (single pass)."""
    return (f"aggregate({lc}, named_struct('prev_jd', CAST(NULL AS DOUBLE), 'last_jd', CAST(NULL AS DOUBLE)), "
            f"(acc, p) -> CASE WHEN {valid_sql('p')} THEN named_struct('prev_jd', acc.last_jd, 'last_jd', p.jd) "
            f"ELSE acc END, acc -> acc.last_jd - acc.prev_jd)")


_PT = "STRUCT<jd: DOUBLE, fid: BIGINT, mag: DOUBLE>"


def fold_orphan_sql(lc: str) -> str:
    """``fold_orphan`` as SQL text."""
    init = ("named_struct('n', 0L, 'n_bright', 0L, "
            f"'v0', CAST(NULL AS {_PT}), 'v1', CAST(NULL AS {_PT}), 'v2', CAST(NULL AS {_PT}), "
            "'sg', 0.0D, 'ng', 0L, 'sr', 0.0D, 'nr', 0L, 'n_sso', 0L)")
    me = "named_struct('jd', p.jd, 'fid', CAST(p.fid AS BIGINT), 'mag', p.magpsf)"
    merge = (f"(acc, p) -> CASE WHEN {valid_sql('p')} THEN named_struct("
             "'n', acc.n + 1L, "
             "'n_bright', acc.n_bright + CASE WHEN NOT (p.magpsf > 18.0D) THEN 1L ELSE 0L END, "
             f"'v0', CASE WHEN acc.n = 0 THEN {me} ELSE acc.v0 END, "
             f"'v1', CASE WHEN acc.n = 1 THEN {me} ELSE acc.v1 END, "
             f"'v2', CASE WHEN acc.n = 2 THEN {me} ELSE acc.v2 END, "
             "'sg', acc.sg + CASE WHEN CAST(p.fid AS BIGINT) = 1 THEN p.magpsf ELSE 0.0D END, "
             "'ng', acc.ng + CASE WHEN CAST(p.fid AS BIGINT) = 1 THEN 1L ELSE 0L END, "
             "'sr', acc.sr + CASE WHEN CAST(p.fid AS BIGINT) = 2 THEN p.magpsf ELSE 0.0D END, "
             "'nr', acc.nr + CASE WHEN CAST(p.fid AS BIGINT) = 2 THEN 1L ELSE 0L END, "
             "'n_sso', acc.n_sso + CASE WHEN coalesce(p.ssnamenr, 'null') != 'null' THEN 1L ELSE 0L END"
             ") ELSE acc END")
    rate = ("CASE WHEN acc.v1.fid = acc.v2.fid THEN (acc.v2.mag - acc.v1.mag) > 0 "
            "WHEN acc.v2.fid > acc.v1.fid THEN (acc.v1.mag - acc.v2.mag) <= 0.3D "
            "ELSE (acc.v2.mag - acc.v1.mag) > 0 END")
    mg = "CASE WHEN acc.ng > 0 THEN acc.sg / acc.ng END"
    mr = "CASE WHEN acc.nr > 0 THEN acc.sr / acc.nr END"
    finish = ("acc -> named_struct("
              "'n_valid', acc.n, 'all_faint', acc.n_bright = 0, 'exactly3', acc.n = 3, "
              "'span3', coalesce(acc.n = 3 AND (acc.v2.jd - acc.v0.jd) < 10.0D, false), "
              f"'valid_rate', coalesce(acc.n = 3 AND {rate}, false), "
              f"'color_ok', coalesce(({mg}) - ({mr}) >= 0, false), "
              f"'no_known_sso', acc.n_sso = 0, 'mean_g', {mg}, 'mean_r', {mr}, "
              f"'all_terms', acc.n_bright = 0 AND acc.n = 3 AND (acc.v2.jd - acc.v0.jd) < 10.0D AND {rate} "
              f"AND coalesce(({mg}) - ({mr}) >= 0, false) AND acc.n_sso = 0)")
    return f"aggregate({lc}, {init}, {merge}, {finish})"


def fold_rate_sql(dc_pts: str, max_mag: float = 21.0, min_span: float = 0.5) -> str:
    """``fold_rate`` as SQL text."""
    init = ("named_struct('np', 0L, 'n', 0L, 'x0', CAST(NULL AS DOUBLE), 'y0', CAST(NULL AS DOUBLE), "
            "'x_last', CAST(NULL AS DOUBLE), 'sw', 0.0D, 'sx', 0.0D, 'sy', 0.0D, 'sxx', 0.0D, 'sxy', 0.0D, "
            "'syy', 0.0D, 'last_mag', CAST(NULL AS DOUBLE), 'last_err', CAST(NULL AS DOUBLE))")
    x0 = "coalesce(acc.x0, q.jd)"
    y0 = "coalesce(acc.y0, q.mag)"
    w = "(1.0D / nullif(POWER(q.err, 2), 0.0D))"
    x = f"(q.jd - {x0})"
    y = f"(q.mag - {y0})"
    merge = (f"(acc, q) -> CASE WHEN coalesce(q.mag < {float(max_mag)!r}D AND q.err > 0 AND NOT isnan(q.err), false) THEN named_struct("
             f"'np', acc.np + 1L, 'n', acc.n + 1L, 'x0', {x0}, 'y0', {y0}, 'x_last', q.jd, "
             f"'sw', acc.sw + {w}, 'sx', acc.sx + {w} * {x}, 'sy', acc.sy + {w} * {y}, "
             f"'sxx', acc.sxx + {w} * {x} * {x}, 'sxy', acc.sxy + {w} * {x} * {y}, "
             f"'syy', acc.syy + {w} * {y} * {y}, 'last_mag', q.mag, 'last_err', q.err) "
             "ELSE named_struct('np', acc.np + 1L, 'n', acc.n, 'x0', acc.x0, 'y0', acc.y0, "
             "'x_last', acc.x_last, 'sw', acc.sw, 'sx', acc.sx, 'sy', acc.sy, 'sxx', acc.sxx, "
             "'sxy', acc.sxy, 'syy', acc.syy, 'last_mag', q.mag, 'last_err', q.err) END")
    den = "nullif(acc.sw * acc.sxx - acc.sx * acc.sx, 0.0D)"
    slope = f"((acc.sw * acc.sxy - acc.sx * acc.sy) / {den})"
    icpt = f"((acc.sy - {slope} * acc.sx) / acc.sw)"
    chi2 = f"(acc.syy - {slope} * acc.sxy - {icpt} * acc.sy)"
    ok = f"coalesce(acc.n >= 2 AND (acc.x_last - acc.x0) > {float(min_span)!r}D, false)"
    finish = (f"acc -> named_struct('n_points', acc.np, 'n_fit', acc.n, 'span', acc.x_last - acc.x0, "
              f"'ok', {ok}, 'slope', CASE WHEN {ok} THEN {slope} END, "
              f"'slope_var', CASE WHEN {ok} AND acc.n > 2 THEN acc.sw / {den} * greatest({chi2}, 0.0D) "
              f"/ (acc.n - 2) END, 'last_mag', acc.last_mag, 'last_err', acc.last_err)")
    return f"aggregate({dc_pts}, {init}, {merge}, {finish})"
