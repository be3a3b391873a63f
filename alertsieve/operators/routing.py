"""Topic routing (S5), notification rows (S6) and channel selection.

The reference posts chat messages from inside its UDFs; here the message
content becomes rows of a table (one row per candidate) and the destinations
become rows of a (topic, alert, channel) table.  Writing them with
``foreachBatch`` keyed on (topic, candid, channel) makes delivery idempotent
across task retries, which in-UDF HTTP calls are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import text as TX
from ..functions.columns import d, flag
from ..functions.sky import galactic_lat_sql, proj_sep_kpc
from . import filters as FL

# channel names: two general ones always, an amateur one per topic, a survey-field one
GENERAL_CHANNELS = ["main", "broker"]
# the amateur channel of each topic: three separate switches
AMATEUR_CHANNELS = {"kn_candidates": "amateur_kn", "early_kn_candidates": "amateur_early_kn",
                    "rate_based_kn_candidates": "amateur_rate_kn"}
SURVEY_CHANNEL = "survey_field"
AMATEUR_MIN_ABS_B = 20.0
AMATEUR_MAX_MAG = 20.0


def route_topics(df: DataFrame, topics: list[str] | None = None,
                 keep: list[str] | None = None) -> DataFrame:
    """One row per (topic, alert) for each per-row filter that passes.

    All flags are evaluated in one projection and exploded -- one scan, no
    shuffle; alerts without any topic produce no row.
    """
    topics = topics or FL.row_topics()
    keep = keep or ["candid", "objectId"]
    def one(t):
        sql = FL.filter_sql(t, df)
        pred = F.expr(f"coalesce({sql}, false)") if sql is not None else flag(FL.get_filter(t).builder(df))
        return F.when(pred, F.lit(FL.get_filter(t).topic))
    names = F.array(*[one(t) for t in topics])
    return (df.select(*keep, F.explode(F.filter(names, lambda x: x.isNotNull())).alias("topic"))
            .select("topic", *keep))


def _common(df: DataFrame, topic: str, fid: Column, days_first: Column) -> list[Column]:
    e = F.expr
    return [F.lit(topic).alias("topic"), F.col("candid"), F.col("objectId"),
            e(TX.jd_to_utc_sql("jd")).alias("obs_utc"), F.col("ra"), F.col("dec"),
            e(TX.ra_hms_sql("ra")).alias("ra_hms"), e(TX.dec_dms_sql("dec")).alias("dec_dms"),
            e(galactic_lat_sql("ra", "dec")).alias("gal_lat"),
            e(TX.band_name_sql("fid")).alias("band"), F.col("mag"), F.col("err_mag"),
            days_first.alias("days_since_first"),
            e(TX.tns_link_sql("ra", "dec")).alias("tns_link"),
            e(TX.portal_link_sql("objectId")).alias("portal_link"),
            e(TX.message_sql("%.2f ± %.2f", "mag", "err_mag")).alias("mag_text"),
            e(TX.message_sql("%.7f %+.7f", "ra", "dec")).alias("coords_text"),
            e(TX.message_sql("%.7f", galactic_lat_sql("ra", "dec"))).alias("gal_lat_text")]


_SCORES = TX.message_sql("%.2f, %.2f, %.2f", "rf_snia_vs_nonia", "snn_snia_vs_nonia", "snn_sn_vs_all")
_SINCE_LAST = TX.message_sql("%.1f days", "days_since_last")
_SINCE_FIRST = TX.message_sql("%.1f days", "(jd - jdstarthist)")


def _texts(**sql: str) -> list[Column]:
    return [F.expr(x).alias(name) for name, x in sql.items()]


def notify_kn(msg_rows: DataFrame) -> DataFrame:
    """S6 for F11 (input: ``kilonova.kn_message_rows``)."""
    return msg_rows.select(
        *_common(msg_rows, "kn_candidates", F.col("fid"), F.col("jd") - F.col("jdstarthist")),
        "rf_kn_vs_nonkn", "rf_snia_vs_nonia", "snn_snia_vs_nonia", "snn_sn_vs_all",
        "days_since_last", "rate", "rate_err", *_texts(
            score_text=TX.message_sql("%.2f", "rf_kn_vs_nonkn"), other_scores_text=_SCORES,
            since_last_text=_SINCE_LAST, since_first_text=_SINCE_FIRST,
            rate_text=TX.message_sql("(%.2f ± %.2f) mag/day", "rate", "rate_err")))


def notify_early_kn(cands: DataFrame) -> DataFrame:
    """S6 for F12 (input: ``kilonova.early_kn_candidates(with_host=True)``)."""
    return cands.select(
        *_common(cands, "early_kn_candidates", F.col("fid"),
                 (F.col("jd") - F.col("jdstarthist")) * d(24.0)),
        F.col("field"),
        F.col("g_hyperleda").alias("host_hyperleda_name"), F.col("g_2mass").alias("host_2mass_name"),
        F.col("g_lum_dist").alias("host_lum_dist"), F.col("g_dist_err").alias("host_dist_err"),
        F.col("g_ra").alias("host_ra"), F.col("g_dec").alias("host_dec"),
        F.col("g_stellarmass").alias("host_stellarmass"),
        proj_sep_kpc(F.col("sep_rad"), F.col("g_ang_dist")).alias("proj_sep_kpc"),
        F.col("abs_mag"), *_texts(
            since_first_text=TX.message_sql("%.1f hours", "((jd - jdstarthist) * 24.0D)"),
            host_text="concat(g_hyperleda, ' / ', g_2mass)",
            host_dist_text=TX.message_sql("(%.2f ± %.2f) Mpc", "g_lum_dist", "g_dist_err"),
            host_coords_text=TX.message_sql("%.7f %+.7f", "g_ra", "g_dec"),
            host_mass_text=TX.message_sql("%.2f", "g_stellarmass"),
            match_text=TX.message_sql("%.2f kpc, M = %.2f", "(sep_rad * g_ang_dist * 1000.0D)", "abs_mag")))


def notify_rate_kn(cands: DataFrame) -> DataFrame:
    """S6 for F13 (input: ``kilonova.rate_based_kn_candidates``).  ``sigma_rate``
    is the slope variance (the reference prints it after a ±)."""
    return cands.select(
        *_common(cands, "rate_based_kn_candidates", F.col("fid"), F.col("jd") - F.col("jdstarthist")),
        "rf_snia_vs_nonia", "snn_snia_vs_nonia", "snn_sn_vs_all", "days_since_last",
        "rate", "sigma_rate", *_texts(
            scores_text=_SCORES, since_last_text=_SINCE_LAST, since_first_text=_SINCE_FIRST,
            rate_text=TX.message_sql("(%.2f ± %.2f) mag/day", "rate", "sigma_rate")))


def notify_channels(notes: DataFrame, as_of: Column | None = None,
                    enabled: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """(topic, candid, channel) rows, with the columns ``keep`` of ``notes``.

    Two general channels always; the topic's amateur channel iff ``|b| > 20``,
    ``mag < 20`` and ``as_of`` is a Friday; the survey-field channel for early
    kilonovae in the listed fields.  ``as_of`` defaults to the observation date
    (the reference reads the wall clock instead).  ``enabled`` replaces the
    environment-variable gating.
    """
    as_of = as_of if as_of is not None else F.to_date(F.substring(F.col("obs_utc"), 1, 10))
    amateur = ((F.abs(F.col("gal_lat")) > d(AMATEUR_MIN_ABS_B)) & (F.col("mag") < d(AMATEUR_MAX_MAG))
               & TX.is_friday(as_of))
    amateur_name = F.lit(None).cast("string")
    for topic, name in AMATEUR_CHANNELS.items():
        amateur_name = F.when(F.col("topic") == topic, F.lit(name)).otherwise(amateur_name)
    field = F.col("field") if "field" in notes.columns else F.lit(None).cast("long")
    survey = (F.col("topic") == F.lit("early_kn_candidates")) & field.isin(S.SURVEY_FIELDS)
    chans = F.array(*[F.lit(c) for c in GENERAL_CHANNELS],
                    F.when(flag(amateur), amateur_name),
                    F.when(flag(survey), F.lit(SURVEY_CHANNEL)))
    out = notes.select("topic", "candid", *(keep or []),
                       F.explode(F.filter(chans, lambda x: x.isNotNull())).alias("channel"))
    if enabled is not None:
        out = out.filter(F.col("channel").isin(list(enabled)))
    return out


def channels_one_pass(topic_rows: DataFrame, as_of: Column | None = None,
                      enabled: list[str] | None = None, obs_date: str | None = None) -> DataFrame:
    """S7 from ``kilonova.kilonova_topic_rows`` (one scan for all three
    kilonova topics): only the inputs of the channel rules are computed.  ``obs_date`` names
    a column for the date of the observation."""
    notes = topic_rows.select(
        "topic", "candid", "mag", "field",
        F.expr(TX.jd_to_utc_sql("jd")).alias("obs_utc"), F.expr(galactic_lat_sql("ra", "dec")).alias("gal_lat"))
    if obs_date:
        notes = notes.withColumn(obs_date, F.substring("obs_utc", 1, 10))
    return notify_channels(notes, as_of, enabled, keep=[obs_date] if obs_date else None)
