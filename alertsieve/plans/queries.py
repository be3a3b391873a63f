"""Registered queries: one per operator of the survey inventory.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the DuckDB oracle in ``plans/oracle.py``.  Doubles are rounded to
6 decimals at the very end only.
"""

from __future__ import annotations


import pandas as pd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lightcurve as L
from ..functions import text as TX
from ..functions.columns import flag, resolve
from ..functions.photometry import dc_mag_sql
from ..functions.sky import galactic_lat_sql
from ..operators import classify as K
from ..operators import filters as FL
from ..operators import kilonova as KN
from ..operators import routing as R
from ..operators.catalogue import build_galaxy_catalogue, read_catalogue, write_catalogue
from ..sources import fixtures as FX
from .tables import alerts, clustered_table_path, galaxies, nightly_path, rounded, sky_objects

Q = {}


def query(name):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


def _ids(df: DataFrame) -> DataFrame:
    return df.select("candid", "objectId")


# --- S1: scan ----------------------------------------------------------------

@query("scan_alerts")
def scan_alerts(spark: SparkSession, sf: str) -> DataFrame:
    a = alerts(spark, sf)
    top = [c for c in a.columns if c not in ("candidate", "prv_candidates")]
    return a.select(*top, "candidate.*", F.size("prv_candidates").cast("long").alias("n_prv"))


# --- F1-F11, F14: per-row filters ----------------------------------------------

def _filter_query(name: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _ids(FL.apply_filter(alerts(spark, sf), name))
    run.__name__ = name
    return run


for _n in FL.ROW_FILTERS:
    Q[_n] = _filter_query(_n)


# --- F12, F13 -------------------------------------------------------------------

@query("early_kn_candidates")
def early_kn(spark: SparkSession, sf: str) -> DataFrame:
    c = KN.early_kn_candidates(alerts(spark, sf), galaxies(spark, sf), sky_objects(spark, sf))
    return c.select("candid", "objectId", F.col("g_idx").alias("galaxy_idx"))


@query("rate_based_kn_candidates")
def rate_kn(spark: SparkSession, sf: str) -> DataFrame:
    c = KN.rate_based_kn_candidates(alerts(spark, sf), sky_objects(spark, sf))
    return rounded(c.select("candid", "objectId", "rate"))


# --- K1-K5 ----------------------------------------------------------------------

@query("alert_flags")
def alert_flags(spark: SparkSession, sf: str) -> DataFrame:
    a = alerts(spark, sf)
    return a.select("candid", *[c.alias("f_" + k) for k, c in K.alert_flags(a).items()])


@query("classify_steps")
def classify_steps(spark: SparkSession, sf: str) -> DataFrame:
    a = alerts(spark, sf)
    p = K.classify_parts_sql(a)
    return a.selectExpr("candid", f"{p['priority']} AS priority_class", f"{p['n_conflicts']} AS n_conflicts",
                        f"{p['class']} AS class")


@query("classify")
def classify(spark: SparkSession, sf: str) -> DataFrame:
    a = alerts(spark, sf)
    return a.select("candid", "objectId", K.classify(a).alias("class"))


# --- A1-A8 ----------------------------------------------------------------------

@query("class_counts")
def class_counts(spark: SparkSession, sf: str) -> DataFrame:
    c = classify(spark, sf)
    return (c.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc_nulls_first("class")).limit(10))


@query("simbad_type_counts")
def simbad_type_counts(spark: SparkSession, sf: str) -> DataFrame:
    a = FL.apply_filter(alerts(spark, sf), "simbad_candidates")
    return (a.filter(F.col("cdsxmatch").isNotNull()).groupBy("cdsxmatch")
            .agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc("cdsxmatch")).limit(5))


def _row_flag_cols(a: DataFrame, names) -> list:
    out = []
    for n in names:
        sql = FL.filter_sql(n, a)
        out.append(F.expr(f"coalesce({sql}, false) AS f_{n}") if sql is not None
                   else flag(FL.get_filter(n).builder(a)).alias("f_" + n))
    return out


@query("filter_counts")
def filter_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A3: count of every filter in ONE scan: per-row flags and both catalogue
    flags (broadcast existence joins) as columns, then one aggregation."""
    a = alerts(spark, sf)
    names = FL.ROW_FILTERS + FL.CATALOGUE_FILTERS
    flags = KN.catalogue_flags(a, galaxies(spark, sf), sky_objects(spark, sf), keep=["candid"],
                               extra=_row_flag_cols(a, FL.ROW_FILTERS))
    one_pass = flags.selectExpr(*[f"count_if(f_{n}) AS {n}" for n in names])
    rows = ", ".join(f"named_struct('filter', '{n}', 'n', CAST({n} AS BIGINT))" for n in names)
    return one_pass.selectExpr(f"inline(array({rows}))")


@query("weighted_fit")
def weighted_fit_q(spark: SparkSession, sf: str) -> DataFrame:
    f = KN.rate_kn_fit(alerts(spark, sf)).filter(F.col("rate").isNotNull())
    return rounded(f.select("candid", "rate", "sigma_rate", "n_fit"))


@query("two_point_rate")
def two_point_rate_q(spark: SparkSession, sf: str) -> DataFrame:
    m = KN.kn_message_rows(alerts(spark, sf))
    return rounded(m.select("candid", "mag", "err_mag", "rate", "rate_err"))


@query("band_means")
def band_means(spark: SparkSession, sf: str) -> DataFrame:
    a = alerts(spark, sf)
    t = a.select("candid", F.expr(L.fold_orphan_sql(L.lc_concat_sql())).alias("t"))
    return rounded(t.selectExpr("candid", "t.mean_g AS mean_g", "t.mean_r AS mean_r"))


@query("galaxy_catalogue")
def galaxy_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """S3 + A7: build the catalogue from the raw table, sorted by distance."""
    return rounded(build_galaxy_catalogue(FX.load_raw_galaxies(spark, sf)))


@query("object_classes")
def object_classes(spark: SparkSession, sf: str) -> DataFrame:
    c = classify(spark, sf)
    return c.groupBy("objectId").agg(
        F.array_join(F.sort_array(F.collect_set("class")), "|").alias("classes"),
        F.count(F.lit(1)).alias("n_alerts"))


# --- L1-L15 -----------------------------------------------------------------------

@query("lightcurve_summary")
def lightcurve_summary(spark: SparkSession, sf: str) -> DataFrame:
    """L1-L9 per alert; each array is staged once, then read by plain column refs."""
    a = alerts(spark, sf)
    staged = a.selectExpr("candid", "candidate.jd AS jd", "candidate.jdstarthist AS jdstarthist",
                          f"{L.lc_concat_sql()} AS lc")
    s2 = staged.selectExpr("*", f"filter(lc, p -> {L.valid_sql('p')}) AS v",
                           f"{L.same_band_sql('lc', 'element_at(lc, -1).fid')} AS sb")
    s3 = s2.selectExpr("*", f"filter({L.with_dc_sql('sb')}, q -> q.mag < 21.0D) AS bright")
    return rounded(s3.selectExpr(
        "candid", "CAST(size(lc) AS BIGINT) AS n_lc", "CAST(size(v) AS BIGINT) AS n_valid",
        "element_at(lc, -1).jd AS last_jd", "element_at(lc, -1).fid AS last_fid",
        "element_at(lc, -1).isdiffpos AS last_isdiffpos", "CAST(size(sb) AS BIGINT) AS n_same_band",
        "CASE WHEN size(sb) >= 2 THEN element_at(sb, -1).magpsf - element_at(sb, -2).magpsf END AS tail2_dmag",
        "CAST(size(bright) AS BIGINT) AS n_bright",
        "try_element_at(bright, -1).jd - try_element_at(bright, 1).jd AS bright_span",
        f"{L.days_since_last_sql('lc')} AS days_since_last",
        "CAST(jd AS DOUBLE) - CAST(jdstarthist AS DOUBLE) AS days_since_first",
    ), exact=("last_jd", "bright_span", "days_since_last", "days_since_first"))


@query("orphan_terms")
def orphan_terms(spark: SparkSession, sf: str) -> DataFrame:
    a = alerts(spark, sf)
    t = a.select("candid", F.expr(L.fold_orphan_sql(L.lc_concat_sql())).alias("t"))
    return t.selectExpr("candid", "t.all_faint AS all_faint", "t.exactly3 AS exactly3", "t.span3 AS span3",
                        "t.valid_rate AS valid_rate", "t.color_ok AS color_ok",
                        "t.no_known_sso AS no_known_sso")


# --- C1-C17 -----------------------------------------------------------------------

@query("photometry_columns")
def photometry_columns(spark: SparkSession, sf: str) -> DataFrame:
    a = alerts(spark, sf)
    staged = a.select("candid", F.expr(dc_mag_sql("candidate.")).alias("dc"),
                      resolve(a, "roid").cast("long").alias("roid_int"))
    return rounded(staged.selectExpr("candid", "dc.mag AS dc_mag", "dc.err AS dc_err", "roid_int"))


@query("astrometry_columns")
def astrometry_columns(spark: SparkSession, sf: str) -> DataFrame:
    a = alerts(spark, sf)
    ra, dec = "candidate.ra", "candidate.dec"
    return rounded(a.selectExpr("candid", f"{galactic_lat_sql(ra, dec)} AS gal_lat",
                                f"{TX.ra_hms_sql(ra)} AS ra_hms", f"{TX.dec_dms_sql(dec)} AS dec_dms"))


@query("text_columns")
def text_columns(spark: SparkSession, sf: str) -> DataFrame:
    a = alerts(spark, sf)
    utc = a.selectExpr("*", f"{TX.jd_to_utc_sql('candidate.jd')} AS obs_utc")
    return utc.selectExpr(
        "candid", "obs_utc", f"{TX.band_name_sql('candidate.fid')} AS band",
        "dayofweek(to_date(substring(obs_utc, 1, 10))) = 6 AS is_friday",
        f"concat('{TX.PORTAL_BASE}', objectId) AS portal_link",
        f"{TX.tns_link_sql('candidate.ra', 'candidate.dec')} AS tns_link",
        f"{TX.message_sql('%.2f', 'candidate.magpsf')} AS mag_text",
        f"{TX.message_sql('%+.7f', 'candidate.dec')} AS dec_text")


# --- J1-J3 --------------------------------------------------------------------------

@query("host_match")
def host_match(spark: SparkSession, sf: str) -> DataFrame:
    pairs = KN.host_match(KN.early_kn_cut_alerts(alerts(spark, sf)), galaxies(spark, sf))
    from ..functions.sky import proj_sep_kpc
    return rounded(pairs.select("candid", F.col("g_idx").alias("galaxy_idx"), "sep_rad", "abs_mag",
                                proj_sep_kpc(F.col("sep_rad"), F.col("g_ang_dist")).alias("proj_sep_kpc")))


@query("host_first")
def host_first(spark: SparkSession, sf: str) -> DataFrame:
    h = KN.nearest_host(KN.early_kn_cut_alerts(alerts(spark, sf)), galaxies(spark, sf))
    return rounded(h.select("candid", F.col("g_idx").alias("galaxy_idx"),
                            F.col("g_lum_dist").alias("lum_dist")))


@query("host_exists")
def host_exists(spark: SparkSession, sf: str) -> DataFrame:
    return KN.host_exists(KN.early_kn_cut_alerts(alerts(spark, sf)), galaxies(spark, sf)).select("candid")


@query("star_veto")
def star_veto(spark: SparkSession, sf: str) -> DataFrame:
    """J3 over every alert: alerts with no star/QSO-type object within 5 arcsec."""
    a = alerts(spark, sf).select("candid", F.col("candidate.ra").alias("ra"),
                                 F.col("candidate.dec").alias("dec"))
    return KN.star_veto(a, sky_objects(spark, sf)).select("candid")


#: Centre (degrees) and radius of the region of ``cone_alerts``.
REGION = (50.0, 28.9, 4.0)


@query("cone_alerts")
def cone_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """S1/J3 on the clustered table: the alerts of a region that have no star/QSO-type object within 5 arcsec."""
    from ..sources.clustered import read_clustered
    ra, dec, radius = REGION
    a = read_clustered(spark, clustered_table_path(spark, sf), ra, dec, radius).select(
        "candid", "objectId", F.col("candidate.ra").alias("ra"), F.col("candidate.dec").alias("dec"))
    return KN.star_veto(a, sky_objects(spark, sf)).select("candid", "objectId")


# --- S2-S7 --------------------------------------------------------------------------

@query("scan_catalogue")
def scan_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Write the prepared catalogue as CSV into the checkpoint folder and
    read it back with the declared schema."""
    from ..session import run_folder
    path = run_folder(spark, "catalogue")
    write_catalogue(build_galaxy_catalogue(FX.load_raw_galaxies(spark, sf), sort=False), path, "csv")
    return rounded(read_catalogue(spark, path, "csv"))


@query("route_topics")
def route_topics(spark: SparkSession, sf: str) -> DataFrame:
    """S5 in ONE scan: every topic flag as a column (catalogue topics through
    broadcast existence joins), exploded to (topic, candid, objectId)."""
    a = alerts(spark, sf)
    topics = [n for n in FL.ROW_FILTERS if FL.REGISTRY[n].topic] + FL.CATALOGUE_FILTERS
    flags = KN.catalogue_flags(a, galaxies(spark, sf), sky_objects(spark, sf), keep=["candid", "objectId"],
                               extra=_row_flag_cols(a, [n for n in topics if n in FL.ROW_FILTERS]))
    names = ", ".join(f"CASE WHEN f_{t} THEN '{t}' END" for t in topics)
    return flags.selectExpr(f"explode(filter(array({names}), x -> x IS NOT NULL)) AS topic", "candid", "objectId")


@query("notify_kn")
def notify_kn(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(R.notify_kn(KN.kn_message_rows(alerts(spark, sf))))


@query("notify_early_kn")
def notify_early_kn(spark: SparkSession, sf: str) -> DataFrame:
    c = KN.early_kn_candidates(alerts(spark, sf), galaxies(spark, sf), sky_objects(spark, sf))
    return rounded(R.notify_early_kn(c))


@query("notify_rate_kn")
def notify_rate_kn(spark: SparkSession, sf: str) -> DataFrame:
    c = KN.rate_based_kn_candidates(alerts(spark, sf), sky_objects(spark, sf))
    return rounded(R.notify_rate_kn(c))


@query("notify_channels")
def notify_channels(spark: SparkSession, sf: str) -> DataFrame:
    """S7 in ONE scan: the three kilonova topics with the magnitude each
    message quotes, then the channel rules."""
    rows = KN.kilonova_topic_rows(alerts(spark, sf), galaxies(spark, sf), sky_objects(spark, sf))
    return R.channels_one_pass(rows)


@query("stream_alerts")
def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """The alerts as a stream (availableNow) -> classify -> parquet sink."""
    from ..schema import ALERT
    from ..sources.alerts import NIGHT
    from ..streaming.stream import run_classification_stream
    from pyspark.sql import types as T
    from .tables import alert_table_path
    schema = T.StructType(ALERT.fields + [T.StructField(NIGHT, T.LongType())])
    # stream the stored, night-partitioned alert table itself (no second copy)
    return run_classification_stream(spark, source_path=alert_table_path(spark, sf), source_schema=schema,
                                     max_files_per_trigger=16)


@query("stream_early_kn")
def stream_early_kn(spark: SparkSession, sf: str) -> DataFrame:
    """J2 on a stream: the early kilonova candidates with their hosts, in append mode."""
    from ..streaming.stream import run_early_kn_stream
    from .tables import alert_table_path
    out = run_early_kn_stream(spark, alert_table_path(spark, sf), galaxies(spark, sf), sky_objects(spark, sf))
    return rounded(out.select("candid", "objectId", F.col("g_idx").alias("galaxy_idx"), "abs_mag"))


@query("notify_stream")
def notify_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The alert table as a stream -> notification rows with published catalogue versions, committed once."""
    from pyspark.sql import types as T
    from ..operators.catalogue import publish_catalogue
    from ..schema import ALERT
    from ..session import run_folder
    from ..sources.alerts import NIGHT
    from ..streaming.stream import read_notifications, run_versioned_stream
    from .tables import alert_table_path
    base = run_folder(spark, "catalogues")
    publish_catalogue(galaxies(spark, sf), f"{base}/galaxies")
    publish_catalogue(sky_objects(spark, sf), f"{base}/sky")
    schema = T.StructType(ALERT.fields + [T.StructField(NIGHT, T.LongType())])
    table = run_versioned_stream(spark, alert_table_path(spark, sf), schema, f"{base}/galaxies", f"{base}/sky",
                                 max_files_per_trigger=16)
    return read_notifications(spark, table).select("topic", "candid", "channel")


# --- counts by night (A1, A2, A3, A8), kept up to date --------------------------------

def _nightly(name: str, column: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        from ..operators import nightly as N
        return getattr(N, column)(spark, nightly_path(spark, sf))
    run.__name__ = name
    return run


for _n in ("class_counts", "label_counts", "filter_counts", "object_classes"):
    Q[f"nightly_{_n}"] = _nightly(f"nightly_{_n}", _n)


# --- tables stored by cell, rules as data -----------------------------------------------

@query("star_veto_bucketed")
def star_veto_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """J3 over every alert by tables stored by cell: the join has no exchange and nothing is broadcast."""
    from ..operators import bucketed as B
    a = alerts(spark, sf).select("candid", F.col("candidate.ra").alias("ra"), F.col("candidate.dec").alias("dec"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    points = B.store_points(a, "ra", "dec", buckets=buckets)
    stars = B.store_catalogue(KN.star_cells(sky_objects(spark, sf)), buckets=buckets)
    return B.bucket_join(points, stars, "ra", "dec", "s_ra", "s_dec", "left_anti", radius_name="s_radius").select("candid")


@query("route_rules")
def route_rules(spark: SparkSession, sf: str) -> DataFrame:
    """User rules given as a table, all routed in one scan through an index over their conjuncts."""
    from ..operators.rule_index import route_rules as route
    return route(alerts(spark, sf), FX.load_rules(spark, sf), ["candid"])


# --- U1-U3 --------------------------------------------------------------------------

@query("filter_by_path")
def filter_by_path(spark: SparkSession, sf: str) -> DataFrame:
    """A filter addressed by dotted path."""
    return _ids(FL.apply_filter(alerts(spark, sf), "alertsieve.operators.filters.sn_candidates"))


@query("user_filter_pandas")
def user_filter_pandas(spark: SparkSession, sf: str) -> DataFrame:
    """A user filter written as a vectorised pandas UDF (the escape hatch)."""
    from ..operators.user_filters import register_pandas_filter
    labels = ["Candidate_YSO", "Candidate_TTau*"]

    def yso_like(cdsxmatch: pd.Series) -> pd.Series:
        """Example user filter in pandas, vectorised over an Arrow batch (a
        closure, so it is shipped to the Python workers by value)."""
        return cdsxmatch.isin(labels)

    register_pandas_filter("user_yso", yso_like, ["cdsxmatch"])
    out = _ids(FL.apply_filter(alerts(spark, sf), "user_yso"))
    FL.unregister_filter("user_yso")
    return out


@query("filter_by_user_path")
def filter_by_user_path(spark: SparkSession, sf: str) -> DataFrame:
    """A user's filter in a module outside this package, addressed by its path."""
    return _ids(FL.apply_filter(alerts(spark, sf), "example_filters.young_supernova"))


@query("route_user_topic")
def route_user_topic(spark: SparkSession, sf: str) -> DataFrame:
    """A registered user filter is routed as a topic like the built-in ones."""
    FL.register_filter("user_bright", lambda df: F.expr(f"CAST({FL.name_sql(df, 'magpsf')} AS DOUBLE) < 17.0D"))
    out = R.route_topics(alerts(spark, sf))
    FL.unregister_filter("user_bright")
    return out



@query("sn_candidates_pandas_udf")
def sn_candidates_pandas_udf(spark: SparkSession, sf: str) -> DataFrame:
    """F9 through a scalar pandas UDF (compare with ``sn_candidates``)."""
    from ..operators.pandas_variants import sn_candidates_udf
    a = alerts(spark, sf)
    return _ids(a.filter(sn_candidates_udf(a)))


@query("classify_pandas_udf")
def classify_pandas_udf(spark: SparkSession, sf: str) -> DataFrame:
    """K5 through a scalar pandas UDF (compare with ``classify``)."""
    from ..operators.pandas_variants import classify_with_udf
    a = alerts(spark, sf)
    return a.select("candid", "objectId", classify_with_udf(a).alias("class"))
