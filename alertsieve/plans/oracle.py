"""DuckDB oracle SQL for the registered queries.

Independent formulation of the same semantics: the alert table is rebuilt
from ``events`` with SQL windows, light-curve operators use DuckDB list
lambdas, and the sky joins are brute-force distance predicates (no cells).
Tables available as views: region nation customer supplier part orders
lineitem events documents embeddings pages benchmark labels conversations.
"""

from __future__ import annotations

import math

from ..functions.sky import GAL_POLE_DEC, GAL_POLE_RA
from ..sources.fixtures import _CDS as CDS_NAMES
from .queries import REGION


def _f(x: float) -> str:
    return f"{float(x)!r}::DOUBLE"


POINT_FIELDS = ["jd", "fid", "magpsf", "sigmapsf", "magnr", "sigmagnr", "magzpsci", "isdiffpos", "ssnamenr"]

ALERTS_CTE = f"""
ev AS (
  SELECT event_id AS e, ts,
         user_id * 8 + CAST(json_extract(props, '$.k') AS BIGINT) % 8 AS obj,
         epoch_us(ts) / 86400000000.0::DOUBLE + 2440587.5::DOUBLE AS jd
  FROM events
),
pt AS (
  SELECT e, ts, obj, jd,
    CAST(1 + ((e * 13) % 101) % 2 AS BIGINT) AS fid,
    16 + ((e * 7919) % 499) / 100.0::DOUBLE AS magpsf,
    0.02::DOUBLE + ((e * 17) % 89) / 1000.0::DOUBLE AS sigmapsf,
    20 + (e % 31) / 10.0::DOUBLE AS magnr,
    0.02::DOUBLE + (e % 13) / 1000.0::DOUBLE AS sigmagnr,
    26 + (e % 5) / 10.0::DOUBLE AS magzpsci,
    CASE WHEN e % 7 = 0 THEN 'f' ELSE 't' END AS isdiffpos,
    CASE WHEN e % 50 = 0 THEN 'Ceres' WHEN e % 50 = 1 THEN NULL ELSE 'null' END AS ssnamenr
  FROM ev
),
hist AS (
  SELECT pt.*,
    min(jd) OVER (PARTITION BY obj ORDER BY ts, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS jdstarthist,
    CAST(row_number() OVER (PARTITION BY obj ORDER BY ts, e) AS BIGINT) AS ndethist,
    list(struct_pack(jd := jd, fid := fid,
                     magpsf := CASE WHEN e % 5 = 0 THEN NULL ELSE magpsf END,
                     sigmapsf := sigmapsf, magnr := magnr, sigmagnr := sigmagnr,
                     magzpsci := magzpsci, isdiffpos := isdiffpos, ssnamenr := ssnamenr))
      OVER (PARTITION BY obj ORDER BY ts, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prv
  FROM pt
),
a AS (
  SELECT
    e AS candid,
    'OBJ' || lpad(CAST(obj AS VARCHAR), 8, '0') AS objectId,
    CASE WHEN obj % 20 <= 8 THEN 'Unknown' WHEN obj % 20 = 9 THEN 'Galaxy'
         WHEN obj % 20 = 10 THEN 'Seyfert_1' WHEN obj % 20 = 11 THEN 'QSO'
         WHEN obj % 20 = 12 THEN 'RRLyr' WHEN obj % 20 = 13 THEN 'Candidate_YSO'
         WHEN obj % 20 = 14 THEN 'Candidate_TTau*' WHEN obj % 20 = 15 THEN 'SN'
         WHEN obj % 20 = 16 THEN 'Candidate_SN*' WHEN obj % 20 = 17 THEN 'Transient'
         WHEN obj % 20 = 18 THEN 'Fail' ELSE NULL END AS cdsxmatch,
    CAST(CASE WHEN (e * 17) % 25 = 0 THEN 3 WHEN (e * 17) % 25 = 1 THEN 2 ELSE 0 END AS BIGINT) AS roid,
    CASE WHEN e % 30 = 0 THEN ((e * 37) % 89) / 89.0::DOUBLE ELSE 0.0::DOUBLE END AS mulens,
    ((e * 5407 + 3) % 983) / 983.0::DOUBLE AS snn_snia_vs_nonia,
    ((e * 4799 + 7) % 977) / 977.0::DOUBLE AS snn_sn_vs_all,
    ((e * 3571 + 1) % 971) / 971.0::DOUBLE AS rf_snia_vs_nonia,
    ((e * 2749 + 9) % 967) / 967.0::DOUBLE AS rf_kn_vs_nonkn,
    ((e * 3571 + 1) % 971) / 971.0::DOUBLE AS rfscore,
    CASE WHEN (e * 29) % 40 = 0 THEN 'TRCK_' || CAST(e AS VARCHAR)
         WHEN (e * 29) % 40 = 1 THEN NULL ELSE '' END AS tracklet,
    jd, jdstarthist, ndethist,
    CASE WHEN e % 101 = 0 THEN NULL ELSE ((e * 7919 + 11) % 997) / 997.0::DOUBLE END AS drb,
    ((e * 6151 + 5) % 991) / 991.0::DOUBLE AS classtar,
    fid, magpsf, sigmapsf, magnr, sigmagnr, magzpsci, isdiffpos,
    ((1 + obj % 150) * 7919 % 36000) / 100.0::DOUBLE + ((e % 7) - 3) * 0.002::DOUBLE AS ra,
    -30 + ((1 + obj % 150) * 4051 % 12000) / 100.0::DOUBLE AS dec,
    CASE WHEN e % 11 = 0 THEN 5.0::DOUBLE WHEN e % 11 = 1 THEN NULL
         WHEN e % 11 = 2 THEN 30.0::DOUBLE ELSE -999.0::DOUBLE END AS ssdistnr,
    ssnamenr,
    CAST(CASE WHEN e % 8 = 0 THEN 1525 WHEN e % 8 = 1 THEN 530 ELSE 600 + e % 8 END AS BIGINT) AS field,
    (e % 53) / 4.0::DOUBLE AS neargaia,
    (e % 47) / 4.0::DOUBLE AS distpsnr1,
    coalesce(len(prv), 0) AS n_prv,
    list_concat(prv, [struct_pack(jd := jd, fid := fid, magpsf := magpsf, sigmapsf := sigmapsf,
                                  magnr := magnr, sigmagnr := sigmagnr, magzpsci := magzpsci,
                                  isdiffpos := isdiffpos, ssnamenr := ssnamenr)]) AS lc
  FROM hist
)"""

GALAXY_CTE = """
graw AS (
  SELECT c_custkey AS galaxy_idx,
    'b''PGC' || CAST(c_custkey AS VARCHAR) || '''' AS HyperLEDA_name,
    'b''J' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') || '''' AS "2MASS_name",
    ((c_custkey * 7919) % 36000) / 100.0::DOUBLE AS RA,
    -30 + ((c_custkey * 4051) % 12000) / 100.0::DOUBLE AS dec,
    CAST(20 + (c_custkey * 31) % 240 AS DOUBLE) AS dist,
    CAST(20 + (c_custkey * 31) % 240 AS DOUBLE) / 10.0::DOUBLE AS dist_err,
    CAST(c_acctbal AS DOUBLE) AS stellarmass,
    CAST(20 + (c_custkey * 31) % 240 AS DOUBLE) * 70 / 299792.458::DOUBLE AS z
  FROM customer
),
g AS (
  SELECT galaxy_idx,
    substring(HyperLEDA_name, 3, length(HyperLEDA_name) - 3) AS HyperLEDA_name,
    substring("2MASS_name", 3, length("2MASS_name") - 3) AS "2MASS_name",
    RA AS ra, dec, dist AS lum_dist, dist_err, stellarmass,
    CASE WHEN dist > 0 AND NOT isnan(z) THEN dist / nullif(pow(1.0::DOUBLE + z, 2), 0) END AS ang_dist
  FROM graw WHERE dist < 230.0::DOUBLE
)"""

SKY_CTE = """
sky AS (
  SELECT p_partkey AS src_id,
    ((p_partkey * 7919) % 36000) / 100.0::DOUBLE + ((p_partkey % 5) - 2) * 0.0005::DOUBLE AS ra,
    -30 + ((p_partkey * 4051) % 12000) / 100.0::DOUBLE AS dec,
    CAST(p_size % 8 AS BIGINT) AS type
  FROM part
),
stars AS (SELECT src_id, ra, dec FROM sky WHERE type IN (1, 3, 4, 6))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def gt(x: str, v: float) -> str:
    return f"({x} > {_f(v)} AND NOT isnan({x}))"


def dc_sql(p: str = "") -> tuple[str, str]:
    fr = f"pow(10.0::DOUBLE, -0.4::DOUBLE * ({p}magnr - {p}magzpsci))"
    fd = f"pow(10.0::DOUBLE, -0.4::DOUBLE * ({p}magpsf - {p}magzpsci))"
    f = (f"(CASE WHEN {p}isdiffpos IN ('t', '1') THEN {fr} + {fd} "
         f"WHEN {p}isdiffpos IS NOT NULL THEN {fr} - {fd} END)")
    mag = f"(CASE WHEN {f} > 0 THEN {p}magzpsci - 2.5::DOUBLE * log10({f}) END)"
    err = f"(CASE WHEN {f} > 0 THEN sqrt(pow({p}sigmagnr * {fr}, 2) + pow({p}sigmapsf * {fd}, 2)) / {f} END)"
    return mag, err


def gal_lat_sql(ra: str, dec: str) -> str:
    dp = math.radians(GAL_POLE_DEC)
    s = (f"sin(radians({dec})) * {_f(math.sin(dp))} + cos(radians({dec})) * {_f(math.cos(dp))} "
         f"* cos(radians({ra}) - {_f(math.radians(GAL_POLE_RA))})")
    known = " AND ".join(f"{x} IS NOT NULL AND NOT isnan({x})" for x in (ra, dec))
    return f"(CASE WHEN {known} THEN degrees(asin(least(greatest({s}, -1.0::DOUBLE), 1.0::DOUBLE))) END)"


def sep_sql(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    h = (f"pow(sin((radians({dec2}) - radians({dec1})) / 2), 2) + cos(radians({dec1})) * cos(radians({dec2})) "
         f"* pow(sin((radians({ra2}) - radians({ra1})) / 2), 2)")
    return f"(2.0::DOUBLE * asin(least(1.0::DOUBLE, sqrt({h}))))"


VALID = "p.magpsf IS NOT NULL AND NOT isnan(p.magpsf)"

# --- predicates over the flat alert CTE `a` ----------------------------------
AGE = "(jd - jdstarthist)"
SNN = f"({gt('snn_snia_vs_nonia', 0.5)} OR {gt('snn_sn_vs_all', 0.5)})"
GALAXY_LIST = ("'galaxy', 'Galaxy', 'EmG', 'Seyfert', 'Seyfert_1', 'Seyfert_2', 'BlueCompG', "
               "'StarburstG', 'LSB_G', 'HII_G', 'High_z_G', 'GinPair', 'GinGroup', 'BClG', 'GinCl', 'PartofG'")
SN_KEEP = f"('Unknown', 'Candidate_SN*', 'SN', 'Transient', 'Fail', {GALAXY_LIST})"
KN_KEEP = f"('Unknown', 'Transient', 'Fail', {GALAXY_LIST})"

PRED = {
    "rrlyr": "cdsxmatch = 'RRLyr'",
    "yso_candidates": "cdsxmatch IN ('Candidate_YSO', 'Candidate_TTau*')",
    "simbad_candidates": "NOT coalesce(cdsxmatch IN ('Unknown', 'Transient', 'Fail'), false)",
    "sso_ztf_candidates": "roid = 3",
    "sso_candidates": "roid = 2",
    "tracklet_candidates": "starts_with(tracklet, 'TRCK_')",
    "microlensing_candidates": gt("mulens", 0.0),
    "snialike": (f"{gt('rfscore', 0.0)} AND cdsxmatch = 'Unknown' AND {gt('neargaia', 5.0)} "
                 f"AND {gt('distpsnr1', 5.0)}"),
    "sn_candidates": (f"{SNN} AND cdsxmatch IN {SN_KEEP} AND {AGE} <= 90.0::DOUBLE AND {gt('drb', 0.5)} "
                      f"AND {gt('classtar', 0.4)} AND ndethist > 1 AND roid <> 3"),
    "early_sn_candidates": (f"{SNN} AND cdsxmatch IN {SN_KEEP} AND {gt('drb', 0.5)} AND {gt('classtar', 0.4)} "
                            f"AND ndethist <= 20 AND {gt('rf_snia_vs_nonia', 0.5)}"),
    "kn_candidates": (f"{gt('rf_kn_vs_nonkn', 0.5)} AND {gt('drb', 0.5)} AND {gt('classtar', 0.4)} "
                      f"AND {AGE} < 20.0::DOUBLE AND ndethist < 20 AND cdsxmatch IN {KN_KEEP}"),
}

ORPHAN_V = f"list_filter(lc, lambda p: {VALID})"
ORPHAN_TERMS = {
    "all_faint": "len(list_filter(v, lambda p: NOT (p.magpsf > 18.0::DOUBLE))) = 0",
    "exactly3": "len(v) = 3",
    "span3": "coalesce(len(v) = 3 AND v[3].jd - v[1].jd < 10.0::DOUBLE, false)",
    "valid_rate": ("coalesce(len(v) = 3 AND (CASE WHEN v[2].fid = v[3].fid THEN v[3].magpsf - v[2].magpsf > 0 "
                   "WHEN v[3].fid > v[2].fid THEN v[2].magpsf - v[3].magpsf <= 0.3::DOUBLE "
                   "ELSE v[3].magpsf - v[2].magpsf > 0 END), false)"),
    "color_ok": ("coalesce(list_avg(list_transform(list_filter(v, lambda p: p.fid = 1), lambda p: p.magpsf)) "
                 "- list_avg(list_transform(list_filter(v, lambda p: p.fid = 2), lambda p: p.magpsf)) >= 0, false)"),
    "no_known_sso": "len(list_filter(v, lambda p: coalesce(p.ssnamenr, 'null') <> 'null')) = 0",
}
PRED["orphan_grb"] = (f"{AGE} <= 30.0::DOUBLE AND " + " AND ".join(f"({t})" for t in ORPHAN_TERMS.values()))

ROW_FILTER_NAMES = ["rrlyr", "yso_candidates", "simbad_candidates", "sso_ztf_candidates", "sso_candidates",
                    "tracklet_candidates", "microlensing_candidates", "snialike", "sn_candidates",
                    "early_sn_candidates", "kn_candidates", "orphan_grb"]
TOPIC_NAMES = [n for n in ROW_FILTER_NAMES if n != "snialike"]

EARLY_KN_CUTS = (f"{gt('drb', 0.5)} AND {gt('classtar', 0.4)} AND {AGE} < 0.25::DOUBLE AND roid <> 3 "
                 f"AND cdsxmatch IN {KN_KEEP}")
RATE_KN_CUTS = (f"{gt('drb', 0.9)} AND {gt('classtar', 0.4)} AND {AGE} < 14.0::DOUBLE AND ndethist < 20 "
                f"AND isdiffpos = 't' AND (ssdistnr > 10.0::DOUBLE OR ssdistnr < 0.0::DOUBLE) "
                f"AND abs({gal_lat_sql('ra', 'dec')}) > 10.0::DOUBLE AND cdsxmatch IN {KN_KEEP}")

_MAG, _ERR = dc_sql("")
_PMAG, _PERR = dc_sql("p.")

EKN_CUT_CTE = f"""
cut AS (
  SELECT candid, objectId, ra, dec, jd, jdstarthist, fid, field, {_MAG} AS mag, {_ERR} AS err_mag
  FROM a WHERE {EARLY_KN_CUTS}
),
cutm AS (SELECT * FROM cut WHERE mag IS NOT NULL)"""

HOST_PAIRS_CTE = f"""
pairs AS (
  SELECT c.*, g.galaxy_idx, g.HyperLEDA_name, g."2MASS_name", g.ra AS g_ra, g.dec AS g_dec,
         g.lum_dist, g.dist_err, g.stellarmass, g.ang_dist,
         {sep_sql('c.ra', 'c.dec', 'g.ra', 'g.dec')} AS sep_rad,
         c.mag - 25.0::DOUBLE - 5.0::DOUBLE * log10(g.lum_dist) AS abs_mag
  FROM cutm c, g
  WHERE abs(c.dec - g.dec) <= 2.0001::DOUBLE
),
hm AS (
  SELECT * FROM pairs
  WHERE ang_dist > 0 AND sep_rad <= least(radians(2.0::DOUBLE), 0.01::DOUBLE / ang_dist) AND sep_rad < 0.01::DOUBLE / ang_dist
    AND abs_mag > -17.0::DOUBLE AND abs_mag < -15.0::DOUBLE
),
hf AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY candid ORDER BY lum_dist, galaxy_idx) AS rk FROM hm
  ) WHERE rk = 1
)"""

STAR_RADIUS = _f(math.radians(5.0 / 3600.0))


def _star_near(alias: str) -> str:
    return (f"EXISTS (SELECT 1 FROM stars s WHERE abs(s.dec - {alias}.dec) <= 0.01::DOUBLE "
            f"AND {sep_sql(f'{alias}.ra', f'{alias}.dec', 's.ra', 's.dec')} <= {STAR_RADIUS})")


EKN_FINAL_CTE = f"""
ekn AS (SELECT * FROM hf h WHERE NOT {_star_near('h')})"""

RATE_FIT_CTE = f"""
rc AS (SELECT * FROM a WHERE {RATE_KN_CUTS}),
r1 AS (
  SELECT rc.*,
    list_transform(list_filter(lc, lambda p: {VALID} AND p.fid = lc[-1].fid),
                   lambda p: struct_pack(jd := p.jd, mag := {_PMAG}, err := {_PERR})) AS dcp,
    list_filter(lc, lambda p: {VALID}) AS vv
  FROM rc
),
r2 AS (
  SELECT r1.*, list_filter(dcp, lambda q: q.mag < 21.0::DOUBLE AND q.err > 0 AND NOT isnan(q.err)) AS pts FROM r1
),
r3 AS (
  SELECT r2.*,
    len(pts) >= 2 AND pts[-1].jd - pts[1].jd > 0.5::DOUBLE AS ok,
    list_sum(list_transform(pts, lambda q: 1.0::DOUBLE / pow(q.err, 2))) AS sw,
    list_sum(list_transform(pts, lambda q: (q.jd - pts[1].jd) / pow(q.err, 2))) AS sx,
    list_sum(list_transform(pts, lambda q: q.mag / pow(q.err, 2))) AS sy,
    list_sum(list_transform(pts, lambda q: pow(q.jd - pts[1].jd, 2) / pow(q.err, 2))) AS sxx,
    list_sum(list_transform(pts, lambda q: (q.jd - pts[1].jd) * q.mag / pow(q.err, 2))) AS sxy
  FROM r2
),
r4 AS (
  SELECT r3.*, (sw * sxy - sx * sy) / nullif(sw * sxx - sx * sx, 0) AS slope,
         nullif(sw * sxx - sx * sx, 0) AS den FROM r3
),
r5 AS (
  SELECT r4.*, (sy - slope * sx) / sw AS icpt FROM r4
),
rfit AS (
  SELECT candid, objectId, ra, dec, jd, jdstarthist, fid, rf_snia_vs_nonia, snn_snia_vs_nonia, snn_sn_vs_all,
    vv[-1].jd - vv[-2].jd AS days_since_last,
    CASE WHEN ok THEN slope END AS rate,
    CASE WHEN ok AND len(pts) > 2 THEN sw / den *
      list_sum(list_transform(pts, lambda q: pow(q.mag - slope * (q.jd - pts[1].jd) - icpt, 2) / pow(q.err, 2)))
      / (len(pts) - 2) END AS sigma_rate,
    CAST(len(pts) AS BIGINT) AS n_fit,
    CASE WHEN len(dcp) >= 2 THEN dcp[-1].mag END AS mag,
    CASE WHEN len(dcp) >= 2 THEN dcp[-1].err END AS err_mag
  FROM r5
),
rkn AS (SELECT * FROM rfit r WHERE rate > 0.3::DOUBLE AND NOT {_star_near('r')})"""

KN_MSG_CTE = f"""
k0 AS (
  SELECT a.*, list_filter(lc, lambda p: {VALID} AND p.fid = lc[-1].fid) AS sb,
         list_filter(lc, lambda p: {VALID}) AS vv
  FROM a WHERE {PRED['kn_candidates']}
),
k1 AS (
  SELECT k0.*, list_transform(sb[-2:], lambda p: struct_pack(jd := p.jd, mag := {_PMAG}, err := {_PERR})) AS t
  FROM k0 WHERE len(sb) >= 2
),
kmsg AS (
  SELECT candid, objectId, ra, dec, jd, jdstarthist, fid, rf_kn_vs_nonkn, rf_snia_vs_nonia,
    snn_snia_vs_nonia, snn_sn_vs_all, vv[-1].jd - vv[-2].jd AS days_since_last,
    t[2].mag AS mag, t[2].err AS err_mag,
    (t[2].mag - t[1].mag) / nullif(t[2].jd - t[1].jd, 0) AS rate,
    sqrt(pow(t[2].err, 2) + pow(t[1].err, 2)) / nullif(t[2].jd - t[1].jd, 0) AS rate_err
  FROM k1
)"""


def r6(x: str) -> str:
    return f"round({x}, 6)"


def jd_utc_sql(jd: str) -> str:
    ms = f"CAST(round(({jd} - 2440587.5::DOUBLE) * 86400000.0::DOUBLE) AS BIGINT)"
    day = f"CAST(floor({ms} / 86400000) AS BIGINT)"
    rem = f"({ms} - {day} * 86400000)"
    return (f"printf('%s %02d:%02d:%02d.%03d', CAST(DATE '1970-01-01' + CAST({day} AS INTEGER) AS VARCHAR), "
            f"{rem} // 3600000, ({rem} // 60000) % 60, ({rem} // 1000) % 60, {rem} % 1000)")


def ra_hms_sql(ra: str) -> str:
    cs = f"CAST(round({ra} / 15.0::DOUBLE * 360000.0::DOUBLE) AS BIGINT)"
    return f"printf('%d %02d %05.2f', {cs} // 360000, ({cs} // 6000) % 60, ({cs} % 6000) / 100.0::DOUBLE)"


def dec_dms_sql(dec: str) -> str:
    ds = f"CAST(round(abs({dec}) * 36000.0::DOUBLE) AS BIGINT)"
    return (f"printf('%s%d %02d %04.1f', CASE WHEN {dec} < 0 THEN '-' ELSE '+' END, {ds} // 36000, "
            f"({ds} // 600) % 60, ({ds} % 600) / 10.0::DOUBLE)")


BAND = "CASE WHEN {f} = 1 THEN 'g' WHEN {f} = 2 THEN 'r' END"
TNS = "printf('https://www.wis-tns.org/search?ra=%.7f&decl=%.7f&radius=5&coords_unit=arcsec', {ra}, {dec})"


def _common_notify(topic: str, days_first: str) -> str:
    return (f"'{topic}' AS topic, candid, objectId, {jd_utc_sql('jd')} AS obs_utc, {r6('ra')} AS ra, "
            f"{r6('dec')} AS dec, {ra_hms_sql('ra')} AS ra_hms, {dec_dms_sql('dec')} AS dec_dms, "
            f"{r6(gal_lat_sql('ra', 'dec'))} AS gal_lat, {BAND.format(f='fid')} AS band, "
            f"{r6('mag')} AS mag, {r6('err_mag')} AS err_mag, {r6(days_first)} AS days_since_first, "
            f"{TNS.format(ra='ra', dec='dec')} AS tns_link, "
            f"'https://alerts.example.org/' || objectId AS portal_link, "
            f"printf('%.2f ± %.2f', mag, err_mag) AS mag_text, printf('%.7f %+.7f', ra, dec) AS coords_text, "
            f"printf('%.7f', {gal_lat_sql('ra', 'dec')}) AS gal_lat_text")


_SCORES = "printf('%.2f, %.2f, %.2f', rf_snia_vs_nonia, snn_snia_vs_nonia, snn_sn_vs_all)"
_SINCE = ("printf('%.1f days', days_since_last) AS since_last_text, "
          "printf('%.1f days', jd - jdstarthist) AS since_first_text")


NOTIFY_KN = f"SELECT {_common_notify('kn_candidates', 'jd - jdstarthist')}, {r6('rf_kn_vs_nonkn')} AS rf_kn_vs_nonkn, " \
            f"{r6('rf_snia_vs_nonia')} AS rf_snia_vs_nonia, {r6('snn_snia_vs_nonia')} AS snn_snia_vs_nonia, " \
            f"{r6('snn_sn_vs_all')} AS snn_sn_vs_all, {r6('days_since_last')} AS days_since_last, " \
            f"{r6('rate')} AS rate, {r6('rate_err')} AS rate_err, printf('%.2f', rf_kn_vs_nonkn) AS score_text, " \
            f"{_SCORES} AS other_scores_text, {_SINCE}, " \
            f"printf('(%.2f ± %.2f) mag/day', rate, rate_err) AS rate_text FROM kmsg"

NOTIFY_EKN = f"SELECT {_common_notify('early_kn_candidates', '(jd - jdstarthist) * 24.0::DOUBLE')}, field, " \
             f"HyperLEDA_name AS host_hyperleda_name, \"2MASS_name\" AS host_2mass_name, " \
             f"{r6('lum_dist')} AS host_lum_dist, {r6('dist_err')} AS host_dist_err, {r6('g_ra')} AS host_ra, " \
             f"{r6('g_dec')} AS host_dec, {r6('stellarmass')} AS host_stellarmass, " \
             f"{r6('sep_rad * ang_dist * 1000.0::DOUBLE')} AS proj_sep_kpc, {r6('abs_mag')} AS abs_mag, " \
             f"printf('%.1f hours', (jd - jdstarthist) * 24.0::DOUBLE) AS since_first_text, " \
             f"HyperLEDA_name || ' / ' || \"2MASS_name\" AS host_text, " \
             f"printf('(%.2f ± %.2f) Mpc', lum_dist, dist_err) AS host_dist_text, " \
             f"printf('%.7f %+.7f', g_ra, g_dec) AS host_coords_text, printf('%.2f', stellarmass) AS host_mass_text, " \
             f"printf('%.2f kpc, M = %.2f', sep_rad * ang_dist * 1000.0::DOUBLE, abs_mag) AS match_text FROM ekn"

NOTIFY_RKN = f"SELECT {_common_notify('rate_based_kn_candidates', 'jd - jdstarthist')}, " \
             f"{r6('rf_snia_vs_nonia')} AS rf_snia_vs_nonia, {r6('snn_snia_vs_nonia')} AS snn_snia_vs_nonia, " \
             f"{r6('snn_sn_vs_all')} AS snn_sn_vs_all, {r6('days_since_last')} AS days_since_last, " \
             f"{r6('rate')} AS rate, {r6('sigma_rate')} AS sigma_rate, {_SCORES} AS scores_text, {_SINCE}, " \
             f"printf('(%.2f ± %.2f) mag/day', rate, sigma_rate) AS rate_text FROM rkn"


_AMATEUR = {"kn_candidates": "amateur_kn", "early_kn_candidates": "amateur_early_kn",
            "rate_based_kn_candidates": "amateur_rate_kn"}


def _channels(src: str, topic: str, has_field: bool) -> str:
    utc = jd_utc_sql("jd")
    friday = f"dayofweek(CAST(substring({utc}, 1, 10) AS DATE)) = 5"
    amateur = (f"coalesce(abs({gal_lat_sql('ra', 'dec')}) > 20.0::DOUBLE AND mag < 20.0::DOUBLE "
               f"AND {friday}, false)")
    survey = "field IN (1525, 530, 482, 1476, 388, 1433)" if has_field else "false"
    return (f"SELECT '{topic}' AS topic, candid, 'main' AS channel FROM {src} "
            f"UNION ALL SELECT '{topic}', candid, 'broker' FROM {src} "
            f"UNION ALL SELECT '{topic}', candid, '{_AMATEUR[topic]}' FROM {src} WHERE {amateur} "
            f"UNION ALL SELECT '{topic}', candid, 'survey_field' FROM {src} WHERE coalesce({survey}, false)")


def _class_sql() -> str:
    f = {k: f"coalesce({PRED[v]}, false)" for k, v in {
        "tracklet": "tracklet_candidates", "simbad": "simbad_candidates", "early_sn": "early_sn_candidates",
        "sn": "sn_candidates", "microlensing": "microlensing_candidates", "kn": "kn_candidates",
        "roid3": "sso_ztf_candidates", "roid2": "sso_candidates"}.items()}
    prio = ("CASE WHEN {roid3} THEN 'Solar System MPC' WHEN {tracklet} THEN 'Tracklet' "
            "WHEN {roid2} THEN 'Solar System candidate' WHEN {kn} THEN 'Kilonova candidate' "
            "WHEN {early_sn} THEN 'Early SN Ia candidate' WHEN {sn} THEN 'SN candidate' "
            "WHEN {microlensing} THEN 'Microlensing candidate' ELSE 'Unknown' END").format(**f)
    namb = ("(CAST({microlensing} AS BIGINT) + CAST({sn} AS BIGINT) + CAST({roid2} AS BIGINT) "
            "+ CAST({roid3} AS BIGINT))").format(**f)
    cls = f"CASE WHEN {f['simbad']} THEN cdsxmatch WHEN {namb} > 1 THEN 'Ambiguous' ELSE {prio} END"
    return f, prio, namb, cls


FLAGS, PRIO, NAMB, CLASS = _class_sql()


def oracle_sql() -> dict[str, str]:
    A = _with(ALERTS_CTE)
    q: dict[str, str] = {}
    q["scan_alerts"] = A + """
SELECT candid, objectId, cdsxmatch, roid, mulens, snn_snia_vs_nonia, snn_sn_vs_all, rf_snia_vs_nonia,
  rf_kn_vs_nonkn, rfscore, tracklet, jd, jdstarthist, ndethist, drb, classtar, fid, magpsf, sigmapsf,
  magnr, sigmagnr, magzpsci, isdiffpos, ra, dec, ssdistnr, ssnamenr, field, neargaia, distpsnr1,
  CAST(n_prv AS BIGINT) AS n_prv
FROM a"""
    for n in ROW_FILTER_NAMES:
        if n == "orphan_grb":
            q[n] = A + f", av AS (SELECT a.*, {ORPHAN_V} AS v FROM a)\nSELECT candid, objectId FROM av WHERE {PRED[n]}"
        else:
            q[n] = A + f"\nSELECT candid, objectId FROM a WHERE {PRED[n]}"
    q["filter_by_path"] = q["sn_candidates"]
    q["sn_candidates_pandas_udf"] = q["sn_candidates"]
    q["user_filter_pandas"] = q["yso_candidates"]

    q["early_kn_candidates"] = _with(ALERTS_CTE, GALAXY_CTE, SKY_CTE, EKN_CUT_CTE, HOST_PAIRS_CTE,
                                     EKN_FINAL_CTE) + "\nSELECT candid, objectId, galaxy_idx FROM ekn"
    q["stream_early_kn"] = _with(ALERTS_CTE, GALAXY_CTE, SKY_CTE, EKN_CUT_CTE, HOST_PAIRS_CTE,
                                 EKN_FINAL_CTE) + "\nSELECT candid, objectId, galaxy_idx, round(abs_mag, 6) AS abs_mag FROM ekn"
    q["rate_based_kn_candidates"] = _with(ALERTS_CTE, SKY_CTE, RATE_FIT_CTE) + \
        "\nSELECT candid, objectId, round(rate, 6) AS rate FROM rkn"

    q["alert_flags"] = A + "\nSELECT candid, " + ", ".join(f"{v} AS f_{k}" for k, v in FLAGS.items()) + " FROM a"
    q["classify_steps"] = A + f"\nSELECT candid, {PRIO} AS priority_class, {NAMB} AS n_conflicts, {CLASS} AS class FROM a"
    q["classify"] = A + f"\nSELECT candid, objectId, {CLASS} AS class FROM a"
    q["stream_alerts"] = q["classify"]
    q["classify_pandas_udf"] = q["classify"]
    q["class_counts"] = A + f""", c AS (SELECT {CLASS} AS class FROM a)
SELECT class, CAST(count(*) AS BIGINT) AS n FROM c GROUP BY class ORDER BY n DESC, class ASC NULLS FIRST LIMIT 10"""
    q["simbad_type_counts"] = A + f"""
SELECT cdsxmatch, CAST(count(*) AS BIGINT) AS n FROM a
WHERE {PRED['simbad_candidates']} AND cdsxmatch IS NOT NULL
GROUP BY cdsxmatch ORDER BY n DESC, cdsxmatch ASC LIMIT 5"""
    q["object_classes"] = A + f""", c AS (SELECT objectId, {CLASS} AS class FROM a)
SELECT objectId, coalesce(string_agg(DISTINCT class, '|' ORDER BY class) FILTER (WHERE class IS NOT NULL), '') AS classes,
       CAST(count(*) AS BIGINT) AS n_alerts
FROM c GROUP BY objectId"""

    counts = " UNION ALL ".join(
        f"SELECT '{n}' AS filter, CAST(count(*) AS BIGINT) AS n FROM av WHERE {PRED[n]}" for n in ROW_FILTER_NAMES)
    q["filter_counts"] = _with(ALERTS_CTE, GALAXY_CTE, SKY_CTE, EKN_CUT_CTE, HOST_PAIRS_CTE, EKN_FINAL_CTE,
                               RATE_FIT_CTE) + f", av AS (SELECT a.*, {ORPHAN_V} AS v FROM a)\n" + counts + \
        " UNION ALL SELECT 'early_kn_candidates', CAST(count(*) AS BIGINT) FROM ekn" \
        " UNION ALL SELECT 'rate_based_kn_candidates', CAST(count(*) AS BIGINT) FROM rkn"

    q["weighted_fit"] = _with(ALERTS_CTE, SKY_CTE, RATE_FIT_CTE) + """
SELECT candid, round(rate, 6) AS rate, round(sigma_rate, 6) AS sigma_rate, n_fit FROM rfit WHERE rate IS NOT NULL"""
    q["two_point_rate"] = _with(ALERTS_CTE, KN_MSG_CTE) + """
SELECT candid, round(mag, 6) AS mag, round(err_mag, 6) AS err_mag, round(rate, 6) AS rate,
       round(rate_err, 6) AS rate_err FROM kmsg"""
    q["band_means"] = A + f""", av AS (SELECT a.*, {ORPHAN_V} AS v FROM a)
SELECT candid,
  round(list_avg(list_transform(list_filter(v, lambda p: p.fid = 1), lambda p: p.magpsf)), 6) AS mean_g,
  round(list_avg(list_transform(list_filter(v, lambda p: p.fid = 2), lambda p: p.magpsf)), 6) AS mean_r
FROM av"""
    q["galaxy_catalogue"] = _with(GALAXY_CTE) + """
SELECT galaxy_idx, HyperLEDA_name, "2MASS_name", round(ra, 6) AS ra, round(dec, 6) AS dec,
  round(lum_dist, 6) AS lum_dist, round(dist_err, 6) AS dist_err, round(stellarmass, 6) AS stellarmass,
  round(ang_dist, 6) AS ang_dist FROM g"""
    q["scan_catalogue"] = q["galaxy_catalogue"]

    q["lightcurve_summary"] = A + f""", l AS (
  SELECT candid, jd, jdstarthist, lc,
    list_filter(lc, lambda p: {VALID}) AS vv,
    list_filter(lc, lambda p: {VALID} AND p.fid = lc[-1].fid) AS sb
  FROM a),
l2 AS (
  SELECT l.*, list_filter(list_transform(sb, lambda p: struct_pack(jd := p.jd, mag := {_PMAG})),
                          lambda q: q.mag < 21.0::DOUBLE) AS bright FROM l)
SELECT candid, CAST(len(lc) AS BIGINT) AS n_lc, CAST(len(vv) AS BIGINT) AS n_valid,
  lc[-1].jd AS last_jd, lc[-1].fid AS last_fid, lc[-1].isdiffpos AS last_isdiffpos,
  CAST(len(sb) AS BIGINT) AS n_same_band,
  round(CASE WHEN len(sb) >= 2 THEN sb[-1].magpsf - sb[-2].magpsf END, 6) AS tail2_dmag,
  CAST(len(bright) AS BIGINT) AS n_bright,
  bright[-1].jd - bright[1].jd AS bright_span,
  vv[-1].jd - vv[-2].jd AS days_since_last,
  jd - jdstarthist AS days_since_first
FROM l2"""
    q["orphan_terms"] = A + f""", av AS (SELECT a.*, {ORPHAN_V} AS v FROM a)
SELECT candid, """ + ", ".join(f"{t} AS {k}" for k, t in ORPHAN_TERMS.items()) + " FROM av"

    q["photometry_columns"] = A + f"\nSELECT candid, round({_MAG}, 6) AS dc_mag, round({_ERR}, 6) AS dc_err, roid AS roid_int FROM a"
    q["astrometry_columns"] = A + f"""
SELECT candid, round({gal_lat_sql('ra', 'dec')}, 6) AS gal_lat, {ra_hms_sql('ra')} AS ra_hms,
  {dec_dms_sql('dec')} AS dec_dms FROM a"""
    utc = jd_utc_sql("jd")
    q["text_columns"] = A + f"""
SELECT candid, {utc} AS obs_utc, {BAND.format(f='fid')} AS band,
  dayofweek(CAST(substring({utc}, 1, 10) AS DATE)) = 5 AS is_friday,
  'https://alerts.example.org/' || objectId AS portal_link, {TNS.format(ra='ra', dec='dec')} AS tns_link,
  printf('%.2f', magpsf) AS mag_text, printf('%+.7f', dec) AS dec_text FROM a"""

    H = _with(ALERTS_CTE, GALAXY_CTE, EKN_CUT_CTE, HOST_PAIRS_CTE)
    q["host_match"] = H + """
SELECT candid, galaxy_idx, round(sep_rad, 6) AS sep_rad, round(abs_mag, 6) AS abs_mag,
  round(sep_rad * ang_dist * 1000.0::DOUBLE, 6) AS proj_sep_kpc FROM hm"""
    q["host_first"] = H + "\nSELECT candid, galaxy_idx, round(lum_dist, 6) AS lum_dist FROM hf"
    q["host_exists"] = H + "\nSELECT DISTINCT candid FROM hm"
    ra0, dec0, radius = REGION
    q["cone_alerts"] = _with(ALERTS_CTE, SKY_CTE) + f"""
SELECT candid, objectId FROM a x WHERE {sep_sql('x.ra', 'x.dec', f'{ra0}::DOUBLE', f'{dec0}::DOUBLE')} <= {math.radians(radius)!r}
  AND NOT {_star_near('x')}"""
    q["star_veto"] = _with(ALERTS_CTE, SKY_CTE) + f"\nSELECT candid FROM a x WHERE NOT {_star_near('x')}"

    topics = " UNION ALL ".join(
        f"SELECT '{n}' AS topic, candid, objectId FROM av WHERE {PRED[n]}" for n in TOPIC_NAMES)
    q["route_topics"] = _with(ALERTS_CTE, GALAXY_CTE, SKY_CTE, EKN_CUT_CTE, HOST_PAIRS_CTE, EKN_FINAL_CTE,
                              RATE_FIT_CTE) + f", av AS (SELECT a.*, {ORPHAN_V} AS v FROM a)\n" + topics + \
        " UNION ALL SELECT 'early_kn_candidates', candid, objectId FROM ekn" \
        " UNION ALL SELECT 'rate_based_kn_candidates', candid, objectId FROM rkn"

    q["filter_by_user_path"] = A + """
SELECT candid, objectId FROM a WHERE cdsxmatch IN ('SN', 'Candidate_SN*') AND jd - jdstarthist <= 30.0::DOUBLE"""
    q["route_user_topic"] = A + f", av AS (SELECT a.*, {ORPHAN_V} AS v FROM a)\n" + topics + \
        " UNION ALL SELECT 'user_bright', candid, objectId FROM av WHERE magpsf < 17.0::DOUBLE"

    q["notify_kn"] = _with(ALERTS_CTE, KN_MSG_CTE) + "\n" + NOTIFY_KN
    q["notify_early_kn"] = _with(ALERTS_CTE, GALAXY_CTE, SKY_CTE, EKN_CUT_CTE, HOST_PAIRS_CTE,
                                 EKN_FINAL_CTE) + "\n" + NOTIFY_EKN
    q["notify_rate_kn"] = _with(ALERTS_CTE, SKY_CTE, RATE_FIT_CTE) + "\n" + NOTIFY_RKN
    q["notify_channels"] = _with(ALERTS_CTE, GALAXY_CTE, SKY_CTE, EKN_CUT_CTE, HOST_PAIRS_CTE, EKN_FINAL_CTE,
                                 RATE_FIT_CTE, KN_MSG_CTE) + "\n" + " UNION ALL ".join([
                                     _channels("kmsg", "kn_candidates", False),
                                     _channels("ekn", "early_kn_candidates", True),
                                     _channels("rkn", "rate_based_kn_candidates", False)])
    for name in ("class_counts", "filter_counts", "object_classes"):
        q[f"nightly_{name}"] = q[name]
    q["nightly_label_counts"] = q["simbad_type_counts"]
    q["notify_stream"] = q["notify_channels"]
    q["star_veto_bucketed"] = q["star_veto"]
    names = "['" + "', '".join(CDS_NAMES) + "']"
    cds = lambda k: f"{names}[CAST(p_partkey * {k} % 19 + 1 AS INT)]"
    within = lambda x, low, width: f"x.{x} >= {low} AND x.{x} < {low} + {width}::DOUBLE"
    q["route_rules"] = A + f"""
SELECT 'rule_' || p_partkey AS topic, candid FROM a x, part WHERE CASE p_partkey % 3
  WHEN 0 THEN x.cdsxmatch = {cds(1)} AND {within('magpsf', '16 + (p_partkey * 37 % 450) / 100.0::DOUBLE', 0.05)}
  WHEN 1 THEN x.cdsxmatch IN ({cds(7)}, {cds(11)}) AND {within('rf_snia_vs_nonia', '(p_partkey * 13 % 90) / 100.0::DOUBLE', 0.01)}
  ELSE {within('classtar', '(p_partkey * 17 % 95) / 100.0::DOUBLE', 0.005)}
    AND {within('drb', '(p_partkey * 29 % 80) / 100.0::DOUBLE', 0.1)} END"""
    return q
