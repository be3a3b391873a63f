"""Kilonova filters that need light-curve maths or catalogues (F11 message, F12, F13).

Order of work follows the cost: cheap per-row cuts first (they push into the
scan and drop ~97% of alerts), then array maths on the survivors only, then
the cell joins against the catalogues with only slim columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import lightcurve as L
from ..functions.columns import d
from ..functions.photometry import dc_mag_sql
from ..functions.sky import ang_sep_sql
from . import filters as FL
from .levelcells import index_catalogue, level_join, nearest
from .skyjoin import DEFAULT_CELL_DEG, checked_broadcast, cone_join, explode_catalogue

HOST_MAX_SEP_DEG = 2.0
HOST_MAX_SEP_RAD_MPC = 0.01        # 10 kpc: sep[rad] < 0.01 / ang_dist[Mpc]
HOST_ABS_MAG_RANGE = (-17.0, -15.0)
STAR_VETO_RADIUS_ARCSEC = 5.0
RATE_MIN = 0.3
RATE_MAX_MAG = 21.0
RATE_MIN_SPAN_DAYS = 0.5


def _alert_core(df: DataFrame) -> list:
    n = lambda x: FL.name_sql(df, x)
    return [F.expr(f"{n('candid')} AS candid"), F.expr(f"{n('objectId')} AS objectId"),
            F.expr(f"CAST({n('ra')} AS DOUBLE) AS ra"), F.expr(f"CAST({n('dec')} AS DOUBLE) AS dec"),
            F.expr(f"CAST({n('jd')} AS DOUBLE) AS jd"),
            F.expr(f"CAST({n('jdstarthist')} AS DOUBLE) AS jdstarthist"),
            F.expr(f"CAST({n('fid')} AS BIGINT) AS fid")]


# ---------------------------------------------------------------------------
# star / QSO veto
# ---------------------------------------------------------------------------

# cell tables are pure functions of (catalogue plan, cell size): build each once
_CELLS: dict = {}


def _cells_memo(kind: str, cat: DataFrame, cell_deg: float, build):
    key = (kind, id(cat), cell_deg)
    if key not in _CELLS or _CELLS[key][0] is not cat:
        _CELLS[key] = (cat, build())
    return _CELLS[key][1]


def star_cells(sky_objects: DataFrame, cell_deg: float = DEFAULT_CELL_DEG) -> DataFrame:
    """Vetoing objects only (filter before exploding), one row per touched cell."""
    return _cells_memo("stars", sky_objects, cell_deg, lambda: _star_cells(sky_objects, cell_deg))


def _star_cells(sky_objects: DataFrame, cell_deg: float) -> DataFrame:
    stars = (sky_objects.filter(F.col("type").isin(S.STAR_TYPES))
             .select(F.col("src_id").alias("s_id"), F.col("ra").alias("s_ra"),
                     F.col("dec").alias("s_dec")))
    r = f"{math.radians(STAR_VETO_RADIUS_ARCSEC / 3600.0)!r}D"
    return explode_catalogue(stars, "s_ra", "s_dec", r, cell_deg, radius_name="s_radius")


def star_veto(alerts: DataFrame, sky_objects: DataFrame, ra: str = "ra", dec: str = "dec",
              cell_deg: float = DEFAULT_CELL_DEG) -> DataFrame:
    """Drop alerts with a star/QSO-type object within 5 arcsec (left anti)."""
    return cone_join(alerts, star_cells(sky_objects, cell_deg), ra, dec, "s_ra", "s_dec",
                     how="left_anti", radius_name="s_radius", cell_deg=cell_deg)


# ---------------------------------------------------------------------------
# early kilonova: host galaxy match (J1, J2, J2s) + veto
# ---------------------------------------------------------------------------

def early_kn_cut_alerts(alerts: DataFrame) -> DataFrame:
    """F12 cuts, then the DC magnitude of the survivors."""
    cut = alerts.filter(FL.early_kn_cuts(alerts))
    staged = cut.select(*_alert_core(cut), F.expr(f"CAST({FL.name_sql(cut, 'field')} AS BIGINT) AS field"),
                        F.expr(dc_mag_sql(FL.measure_prefix(cut))).alias("_dc"))
    return (staged.selectExpr(*[x for x in staged.columns if x != "_dc"], "_dc.mag AS mag",
                              "_dc.err AS err_mag")
            .filter(F.col("mag").isNotNull()))


def galaxy_cells(galaxies: DataFrame, cell_deg: float = DEFAULT_CELL_DEG) -> DataFrame:
    """Host-galaxy search discs (J1 radius), one row per touched cell."""
    return _cells_memo("galaxies", galaxies, cell_deg, lambda: _galaxy_cells(galaxies, cell_deg))


HOST_RADIUS = f"least({math.radians(HOST_MAX_SEP_DEG)!r}D, {HOST_MAX_SEP_RAD_MPC!r}D / g_ang_dist)"
#: Order of hosts: nearest to Earth, then index, names and position (a missing value comes first).
HOST_ORDER = ["g_lum_dist", "g_idx", "g_hyperleda", "g_2mass", "g_ra", "g_dec", "g_dist_err", "g_stellarmass", "g_ang_dist"]


def _hosts(galaxies: DataFrame) -> DataFrame:
    """Galaxies that can be hosts.  One without a usable distance has no host radius: it can't match."""
    index = F.col("galaxy_idx") if "galaxy_idx" in galaxies.columns else F.lit(None).cast("long")
    return galaxies.select(
        index.alias("g_idx"), F.col("HyperLEDA_name").alias("g_hyperleda"),
        F.col("`2MASS_name`").alias("g_2mass"), F.col("ra").alias("g_ra"),
        F.col("dec").alias("g_dec"), F.col("lum_dist").alias("g_lum_dist"),
        F.col("dist_err").alias("g_dist_err"), F.col("stellarmass").alias("g_stellarmass"),
        F.expr("CASE WHEN ang_dist > 0 AND NOT isnan(ang_dist) THEN CAST(ang_dist AS DOUBLE) END")
        .alias("g_ang_dist")).filter("g_ang_dist IS NOT NULL")


def _galaxy_cells(galaxies: DataFrame, cell_deg: float) -> DataFrame:
    return explode_catalogue(_hosts(galaxies), "g_ra", "g_dec", HOST_RADIUS, cell_deg, radius_name="g_radius")


def host_index(galaxies: DataFrame) -> DataFrame:
    """Host-galaxy search discs in cells that fit their radii (``levelcells``)."""
    return _cells_memo("hosts", galaxies, 0.0, lambda: index_catalogue(
        _hosts(galaxies), "g_ra", "g_dec", HOST_RADIUS, radius_name="g_radius"))


def _host_residual(ra: str = "ra", dec: str = "dec", mag: str = "mag", host: str = "") -> str:
    """J1 residual: 10 kpc projected and -17 < M < -15 (SQL text); ``host`` is the prefix of the galaxy's columns."""
    sep = ang_sep_sql(ra, dec, f"{host}g_ra", f"{host}g_dec")
    m_abs = f"({mag} - 25.0D - 5.0D * LOG10({host}g_lum_dist))"
    lo, hi = HOST_ABS_MAG_RANGE
    return (f"{sep} < {HOST_MAX_SEP_RAD_MPC!r}D / {host}g_ang_dist AND {m_abs} > {lo!r}D AND {m_abs} < {hi!r}D")


_ABS_MAG = "mag - 25.0D - 5.0D * LOG10(g_lum_dist)"


def host_match(cut: DataFrame, galaxies: DataFrame) -> DataFrame:
    """(alert, galaxy) pairs within 2 deg and 10 kpc with -17 < M < -15.  Rows of ``cut``
    are numbered (``_alert``), so alerts that repeat an id stay apart."""
    cut = cut.withColumn("_alert", F.monotonically_increasing_id())
    pairs = level_join(cut, host_index(galaxies), "ra", "dec", "g_ra", "g_dec", radius_name="g_radius",
                       extra=_host_residual())
    return pairs.withColumn("abs_mag", F.expr(_ABS_MAG))


def nearest_host(cut: DataFrame, galaxies: DataFrame) -> DataFrame:
    """One host per alert row, the first in ``HOST_ORDER`` of those that match as in ``host_match``.

    Every alert row meets the folded cells of the catalogue and chooses inside the row: no aggregation and no exchange
    behind the join, so the host choice also runs on a stream in append mode."""
    within = f"{ang_sep_sql('ra', 'dec', 's.g_ra', 's.g_dec')} <= {HOST_RADIUS.replace('g_ang_dist', 's.g_ang_dist')}"
    met = nearest(cut, host_index(galaxies), HOST_ORDER, "ra", "dec", f"{within} AND {_host_residual(host='s.')}")
    flat = met.select(*[F.col(f"`{c}`") for c in cut.columns], *[F.col(f"_source.{c}").alias(c) for c in HOST_ORDER])
    return flat.withColumn("sep_rad", F.expr(ang_sep_sql("ra", "dec", "g_ra", "g_dec"))).withColumn("abs_mag", F.expr(_ABS_MAG))


def host_first(pairs: DataFrame) -> DataFrame:
    """J2 from a table of pairs: one host per alert row of ``host_match``, the same as ``nearest_host`` finds without
    the pairs.  Partial aggregation runs before the shuffle."""
    alert_cols = [c for c in pairs.columns if not c.startswith("g_") and c not in ("sep_rad", "abs_mag", "_alert")]
    host_cols = ["g_lum_dist", "g_idx"] + [c for c in pairs.columns
                                           if c.startswith("g_") and c not in ("g_lum_dist", "g_idx")]
    # group on the alert row only; its columns ride in the struct
    fields = host_cols + ["sep_rad", "abs_mag"] + alert_cols
    best = F.expr("min(struct(" + ", ".join(f"`{c}`" for c in fields) + ")) AS h")
    return pairs.groupBy("_alert").agg(best).selectExpr(
        *[f"h.`{x}` AS `{x}`" for x in alert_cols], *[f"h.`{x}` AS `{x}`" for x in host_cols + ["sep_rad", "abs_mag"]])


def host_exists(cut: DataFrame, galaxies: DataFrame, cell_deg: float = DEFAULT_CELL_DEG) -> DataFrame:
    """J2s: alerts with at least one host (left semi with the J1 residual)."""
    cells = galaxy_cells(galaxies, cell_deg)
    return cone_join(cut, cells, "ra", "dec", "g_ra", "g_dec", how="left_semi",
                     radius_name="g_radius", cell_deg=cell_deg, extra=_host_residual())


def early_kn_candidates(alerts: DataFrame, galaxies: DataFrame, sky_objects: DataFrame,
                        cell_deg: float = DEFAULT_CELL_DEG, with_host: bool = True) -> DataFrame:
    """cuts -> host galaxy -> star veto.  With ``with_host`` one row per
    alert carries its chosen host (for notifications)."""
    cut = early_kn_cut_alerts(alerts)
    if with_host:
        hosted = nearest_host(cut, galaxies)
    else:
        hosted = host_exists(cut, galaxies, cell_deg)
    return star_veto(hosted, sky_objects, cell_deg=cell_deg)


def early_kn_rows(alerts: DataFrame, galaxies: DataFrame, sky_objects: DataFrame,
                  cell_deg: float = DEFAULT_CELL_DEG) -> DataFrame:
    """F12 as a filter: the alert rows, unchanged.  Cuts first, then a semi join with the host
    galaxies and an anti join with the stars, each on the rows that are left."""
    n = lambda x: f"CAST({FL.name_sql(alerts, x)} AS DOUBLE)"
    cut = alerts.filter(FL.early_kn_cuts(alerts)).selectExpr(
        "*", f"{n('ra')} AS _f_ra", f"{n('dec')} AS _f_dec",
        f"({dc_mag_sql(FL.measure_prefix(alerts))}).mag AS _f_mag").filter("_f_mag IS NOT NULL")
    hosted = cone_join(cut, galaxy_cells(galaxies, cell_deg), "_f_ra", "_f_dec", "g_ra", "g_dec", how="left_semi",
                       radius_name="g_radius", cell_deg=cell_deg, extra=_host_residual("_f_ra", "_f_dec", "_f_mag"))
    return star_veto(hosted, sky_objects, "_f_ra", "_f_dec", cell_deg).drop("_f_ra", "_f_dec", "_f_mag")


def rate_kn_rows(alerts: DataFrame, sky_objects: DataFrame, cell_deg: float = DEFAULT_CELL_DEG) -> DataFrame:
    """F13 as a filter: the alert rows, unchanged.  Cuts, then the fit, then the star veto."""
    n = lambda x: f"CAST({FL.name_sql(alerts, x)} AS DOUBLE)"
    cut = alerts.filter(FL.rate_kn_cuts(alerts)).selectExpr(
        "*", f"{n('ra')} AS _f_ra", f"{n('dec')} AS _f_dec", f"({_fit_sql(alerts)}).slope AS _f_rate")
    fast = cut.filter(F.col("_f_rate") > d(RATE_MIN))
    return star_veto(fast, sky_objects, "_f_ra", "_f_dec", cell_deg).drop("_f_ra", "_f_dec", "_f_rate")


# ---------------------------------------------------------------------------
# rate-based kilonova
# ---------------------------------------------------------------------------

def _lc_sql(alerts: DataFrame) -> str:
    return L.lc_concat_sql(FL.name_sql(alerts, "prv_candidates"), FL.current_sql(alerts))


def _fit_sql(alerts: DataFrame) -> str:
    """The fold of the same-band DC light curve (A4, A5)."""
    fid = f"CAST({FL.name_sql(alerts, 'fid')} AS BIGINT)"
    return L.fold_rate_sql(L.with_dc_sql(L.same_band_sql(_lc_sql(alerts), fid)), RATE_MAX_MAG, RATE_MIN_SPAN_DAYS)


def rate_kn_fit(alerts: DataFrame) -> DataFrame:
    """F13 cuts, then the same-band DC light curve and its weighted slope (A4).

    One fold over the DC points yields the fit, its span and the newest
    magnitude; the light curve expression is referenced exactly once, so a
    filter on ``rate`` pushed below this projection stays linear in size.
    """
    cut = alerts.filter(FL.rate_kn_cuts(alerts))
    staged = cut.select(
        *_alert_core(cut), "rf_snia_vs_nonia", "snn_snia_vs_nonia", "snn_sn_vs_all",
        F.expr(L.days_since_last_sql(_lc_sql(cut))).alias("days_since_last"), F.expr(_fit_sql(cut)).alias("_fit"))
    return staged.selectExpr(
        *[x for x in staged.columns if not x.startswith("_")],
        "_fit.slope AS rate", "_fit.slope_var AS sigma_rate", "_fit.n_fit AS n_fit",
        "CASE WHEN _fit.n_points >= 2 THEN _fit.last_mag END AS mag",
        "CASE WHEN _fit.n_points >= 2 THEN _fit.last_err END AS err_mag",
    )


def rate_based_kn_candidates(alerts: DataFrame, sky_objects: DataFrame,
                             cell_deg: float = DEFAULT_CELL_DEG) -> DataFrame:
    """slope > 0.3 mag/day, then the star veto."""
    fast = rate_kn_fit(alerts).filter(F.col("rate") > d(RATE_MIN))
    return star_veto(fast, sky_objects, cell_deg=cell_deg)


# ---------------------------------------------------------------------------
# classifier-based kilonova message content
# ---------------------------------------------------------------------------

def kn_message_rows(alerts: DataFrame) -> DataFrame:
    """Alerts passing F11 with at least two same-band detections: last DC
    magnitude and the two-point rate (A5)."""
    kn = alerts.filter(FL.kn_candidates(alerts))
    lc = _lc_sql(kn)
    sb = L.same_band_sql(lc, f"CAST({FL.name_sql(kn, 'fid')} AS BIGINT)")
    tail = L.with_dc_sql(f"slice({sb}, -2, 2)")
    staged = kn.select(
        *_alert_core(kn), "rf_kn_vs_nonkn", "rf_snia_vs_nonia", "snn_snia_vs_nonia", "snn_sn_vs_all",
        F.expr(L.days_since_last_sql(lc)).alias("days_since_last"), F.expr(tail).alias("_t"))
    return (staged.filter("size(_t) >= 2")
            .selectExpr(*[x for x in staged.columns if not x.startswith("_")],
                        "_t[1].mag AS mag", "_t[1].err AS err_mag",
                        "(_t[1].mag - _t[0].mag) / nullif(_t[1].jd - _t[0].jd, 0.0D) AS rate",
                        "SQRT(POWER(_t[1].err, 2) + POWER(_t[0].err, 2)) / nullif(_t[1].jd - _t[0].jd, 0.0D)"
                        " AS rate_err"))


# ---------------------------------------------------------------------------
# one-pass flags: both catalogue filters as boolean columns (EXISTS subqueries
# planned as broadcast existence joins -- one output row per alert, no
# multiplication, no aggregation), next to every per-row flag.
# ---------------------------------------------------------------------------

# salt buckets for existence probes that cannot be broadcast (AQE's skew-join
# splitting does not apply to existence joins)
EXISTS_SALT_BUCKETS = 16


def _exists_within(cells: DataFrame, cat_ra: str, cat_dec: str, radius: str,
                   extra: Column | None = None, need: str | None = None) -> Column:
    """EXISTS (catalogue row in the alert's cell within its radius [AND extra]).

    Outer references use names that exist nowhere in the catalogue lineage
    (``_a_cell``, ``_a_ra``, ``_a_dec``); the cell equality makes the existence
    join an equi-join (hash probe), the separation is the residual."""
    from ..functions.sky import ang_sep
    ra_o, dec_o = F.col("_a_ra").outer(), F.col("_a_dec").outer()
    cond = F.col("_cell") == F.col("_a_cell").outer()
    if need is not None:          # cheap outer flag first: AND short-circuits the distance maths
        cond = cond & F.col(need).outer()
    if extra is not None:
        cond = cond & extra
    cond = cond & (ang_sep(ra_o, dec_o, F.col(cat_ra), F.col(cat_dec)) <= F.col(radius))
    side = checked_broadcast(cells)
    if side is cells:
        # too large to broadcast: spread each cell over as many join keys as ``_a_salt`` has
        # values; every catalogue row is replicated once per salt, so any salt finds it
        side = cells.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                              F.lit(EXISTS_SALT_BUCKETS - 1).cast("long"))))
        cond = cond & (F.col("_salt") == F.col("_a_salt").outer())
    return side.where(cond).exists()


def _probe_catalogues(alerts: DataFrame, galaxies: DataFrame, sky_objects: DataFrame,
                      cell_deg: float, keep: list[str], extra: list[Column]) -> DataFrame:
    """One scan of ``alerts`` with both catalogue filters evaluated as
    broadcast existence joins.  Internal columns start with ``_a_``:
    ``_a_hosted`` / ``_a_no_star`` / ``_a_rkn_fast``, the same-band DC fold
    ``_a_fold`` (shared by the kn and rate-kn magnitudes), ``_a_mag`` (DC
    magnitude of the newest point, for rows passing the early-kn cuts)."""
    from ..functions.sky import ang_sep, point_cell_sql
    n = lambda x: FL.name_sql(alerts, x)
    ra_sql, dec_sql = f"CAST({n('ra')} AS DOUBLE)", f"CAST({n('dec')} AS DOUBLE)"
    rkn_cut = f"coalesce({FL.rate_kn_cuts_sql(alerts)}, false)"
    kn = f"coalesce({FL.kn_candidates_sql(alerts)}, false)"
    fold = _fit_sql(alerts)
    staged = alerts.select(
        *keep, *extra,
        F.expr(f"{ra_sql} AS _a_ra"), F.expr(f"{dec_sql} AS _a_dec"),
        F.expr(point_cell_sql(ra_sql, dec_sql, cell_deg)).alias("_a_cell"),
        F.expr(f"pmod(xxhash64({n('candid')}), {EXISTS_SALT_BUCKETS})").alias("_a_salt"),
        F.expr(f"coalesce({FL.early_kn_cuts_sql(alerts)}, false)").alias("_a_ekn_cut"),
        F.expr(f"CASE WHEN coalesce({FL.early_kn_cuts_sql(alerts)}, false) THEN "
               f"({dc_mag_sql(FL.measure_prefix(alerts))}).mag END").alias("_a_mag"),
        F.expr(rkn_cut).alias("_a_rkn_cut"), F.expr(kn).alias("_a_kn"),
        F.expr(f"CASE WHEN {rkn_cut} OR {kn} THEN {fold} END").alias("_a_fold"))
    fast = staged.select("*", F.expr(f"_a_rkn_cut AND coalesce(_a_fold.slope > {RATE_MIN!r}D, false)")
                         .alias("_a_rkn_fast"))
    m_abs = F.col("_a_mag").outer() - d(25.0) - d(5.0) * F.log10(F.col("g_lum_dist"))
    host_extra = ((m_abs > d(HOST_ABS_MAG_RANGE[0])) & (m_abs < d(HOST_ABS_MAG_RANGE[1]))
                  & (ang_sep(F.col("_a_ra").outer(), F.col("_a_dec").outer(), F.col("g_ra"), F.col("g_dec"))
                     < d(HOST_MAX_SEP_RAD_MPC) / F.col("g_ang_dist")))
    if galaxies is not None:
        has_host = _exists_within(galaxy_cells(galaxies, cell_deg), "g_ra", "g_dec", "g_radius", host_extra,
                                  need="_a_ekn_cut")
        hosted = fast.select("*", (F.col("_a_ekn_cut") & has_host).alias("_a_hosted"))
    else:                            # no galaxy catalogue: the early-kn filter cannot pass
        hosted = fast.select("*", F.lit(False).alias("_a_hosted"))
    # the star veto is only probed for rows that could still pass a catalogue filter
    need = hosted.select("*", (F.col("_a_hosted") | F.col("_a_rkn_fast")).alias("_a_need"))
    near_star = _exists_within(star_cells(sky_objects, cell_deg), "s_ra", "s_dec", "s_radius", need="_a_need")
    return need.select("*", (~near_star).alias("_a_no_star"))


def catalogue_flags(alerts: DataFrame, galaxies: DataFrame, sky_objects: DataFrame,
                    cell_deg: float = DEFAULT_CELL_DEG, keep: list[str] | None = None,
                    extra: list[Column] | None = None) -> DataFrame:
    """Alerts with ``f_early_kn_candidates`` and ``f_rate_based_kn_candidates``
    (non-null booleans) computed in one pass, plus the columns in ``keep`` and
    the (aliased) expressions in ``extra`` -- e.g. every per-row flag."""
    keep = keep or ["candid", "objectId"]
    probed = _probe_catalogues(alerts, galaxies, sky_objects, cell_deg, keep, extra or [])
    out = [c for c in probed.columns if not c.startswith("_a_")]
    return probed.select(
        *out,
        (F.col("_a_hosted") & F.col("_a_no_star")).alias("f_early_kn_candidates"),
        (F.col("_a_rkn_fast") & F.col("_a_no_star")).alias("f_rate_based_kn_candidates"))


def kilonova_topic_rows(alerts: DataFrame, galaxies: DataFrame, sky_objects: DataFrame,
                        cell_deg: float = DEFAULT_CELL_DEG) -> DataFrame:
    """(topic, candid, objectId, jd, ra, dec, mag, field) for every kilonova
    notification -- kn (with at least two same-band detections), early kn and
    rate kn -- from ONE scan; ``mag`` is the magnitude each message quotes."""
    keep = ["candid", "objectId"]
    # only rows that can pass one of the three filters meet the catalogues
    may = " OR ".join(f"coalesce({sql(alerts)}, false)" for sql in (
        FL.kn_candidates_sql, FL.early_kn_cuts_sql, FL.rate_kn_cuts_sql))
    alerts = alerts.filter(may)
    extra = [F.expr(f"CAST({FL.name_sql(alerts, 'jd')} AS DOUBLE) AS jd"),
             F.expr(f"CAST({FL.name_sql(alerts, 'field')} AS BIGINT) AS field")]
    p = _probe_catalogues(alerts, galaxies, sky_objects, cell_deg, keep, extra)
    last = "CASE WHEN _a_fold.n_points >= 2 THEN _a_fold.last_mag END"
    rows = (f"filter(array("
            f"CASE WHEN _a_kn AND _a_fold.n_points >= 2 THEN named_struct('topic', 'kn_candidates', 'mag', {last}) END, "
            f"CASE WHEN _a_hosted AND _a_no_star THEN named_struct('topic', 'early_kn_candidates', 'mag', _a_mag) END, "
            f"CASE WHEN _a_rkn_fast AND _a_no_star THEN named_struct('topic', 'rate_based_kn_candidates', "
            f"'mag', {last}) END), x -> x IS NOT NULL)")
    return p.select("candid", "objectId", "jd", "field", F.col("_a_ra").alias("ra"), F.col("_a_dec").alias("dec"),
                    F.explode(F.expr(rows)).alias("t")).select(
        F.col("t.topic").alias("topic"), "candid", "objectId", "jd", "ra", "dec", F.col("t.mag").alias("mag"),
        "field")
