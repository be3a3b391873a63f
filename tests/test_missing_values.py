"""Missing coordinates, errors and distances (NULL, NaN, zero) give NULL or no match, never an error."""

import math

import pytest
from pyspark.sql import functions as F

from alertsieve.functions import lightcurve as L
from alertsieve.functions import sky
from alertsieve.functions import text as TX
from alertsieve.operators import filters as FL
from alertsieve.operators import kilonova as KN
from alertsieve.operators.catalogue import build_galaxy_catalogue
from helpers import alert, alerts_df, point

NAN = float("nan")
RAW = ("galaxy_idx long, HyperLEDA_name string, 2MASS_name string, RA double, dec double, dist double, "
       "dist_err double, stellarmass double, z double")


def coords(spark):
    return spark.createDataFrame([(10.0, 20.0), (None, 20.0), (10.0, None), (NAN, 20.0), (10.0, NAN)],
                                 "ra double, dec double")


def test_latitude_and_text_of_missing_coordinates(spark):
    df = coords(spark)
    sql = df.selectExpr(*[f"{x} AS v{i}" for i, x in enumerate([
        sky.galactic_lat_sql("ra", "dec"), TX.tns_link_sql("ra", "dec"),
        TX.message_sql("%.7f %+.7f", "ra", "dec")])]).collect()
    col = df.select(sky.galactic_lat(F.col("ra"), F.col("dec")), TX.tns_link(F.col("ra"), F.col("dec"))).collect()
    assert all(v is not None for v in sql[0]) and all(v is not None for v in col[0])
    assert all(v is None for r in sql[1:] + col[1:] for v in r)


def test_formatted_columns_of_missing_values(spark):
    df = spark.createDataFrame([(None,), (NAN,)], "x double")
    rows = df.selectExpr(TX.jd_to_utc_sql("x"), TX.ra_hms_sql("x"), TX.dec_dms_sql("x"), TX.fmt_fixed_sql("x", 2)).collect()
    rows += df.select(TX.jd_to_utc(F.col("x")), TX.ra_hms(F.col("x")), TX.dec_dms(F.col("x")),
                      TX.fmt_fixed(F.col("x"), 2)).collect()
    assert all(v is None for r in rows for v in r)


@pytest.mark.parametrize("bad", [0.0, None, NAN])
def test_fit_leaves_out_points_without_error(spark, bad):
    pts = [(1.0, 18.0, 0.1), (2.0, 18.5, bad), (3.0, 19.0, 0.1), (4.0, 19.5, 0.2)]
    df = spark.createDataFrame([(pts,), ([p for p in pts if p[1] != 18.5],)],
                               "p array<struct<jd: double, mag: double, err: double>>")
    for fit in (F.expr(L.fold_rate_sql("p")), L.fold_rate(F.col("p"))):
        with_bad, without = [r["f"] for r in df.select(fit.alias("f")).collect()]
        assert with_bad["n_fit"] == without["n_fit"] == 3
        assert with_bad["slope"] == pytest.approx(without["slope"]) and with_bad["span"] == 3.0


def test_rate_filter_needs_coordinates(spark):
    rows = [alert(1, [point(2459999.0)], ra=None), alert(2, [point(2459999.0)], dec=NAN), alert(3, [point(2459999.0)])]
    df = alerts_df(spark, rows).withColumn("candidate", F.col("candidate").withField("drb", F.lit(0.95))
                                           .withField("ssdistnr", F.lit(-999.0)))
    got = {r.candid: r.ok for r in df.select("candid", FL.rate_kn_cuts(df).alias("ok")).collect()}
    assert not got[1] and not got[2] and got[3]


def test_galaxies_without_distance_match_nothing(spark):
    raw = spark.createDataFrame([
        (1, "b'A'", "b'B'", 150.0, 40.0, 0.0, 1.0, 1.0, 0.01), (2, "b'A'", "b'B'", 150.0, 40.0, 50.0, 1.0, 1.0, NAN),
        (3, "b'A'", "b'B'", 150.0, 40.0, 50.0, 1.0, 1.0, -1.0), (4, "b'A'", "b'B'", 150.0, 40.0, 50.0, 1.0, 1.0, None)], RAW)
    cat = build_galaxy_catalogue(raw)
    assert [r.ang_dist for r in cat.collect()] == [None] * 4
    cut = spark.createDataFrame([(7, 150.0, 40.0, 17.0)], "candid long, ra double, dec double, mag double")
    loose = cat.withColumn("ang_dist", F.lit(math.nan))  # a catalogue from elsewhere
    for c in (cat, loose, cat.withColumn("ang_dist", F.lit(0.0))):
        assert KN.host_match(cut, c).count() == 0 and KN.host_exists(cut, c).count() == 0


def test_host_first_keeps_repeated_and_unnamed_alerts(spark):
    raw = spark.createDataFrame([(1, "b'N1'", "b'J1'", 150.0, 40.0, 50.0, 1.0, 1.0, 0.0),
                                 (2, "b'N2'", "b'J2'", 150.0, 40.0, 50.0, 1.0, 1.0, 0.0)], RAW)
    cat = build_galaxy_catalogue(raw)
    cut = spark.createDataFrame([(7, 150.0, 40.0, 17.5), (7, 150.0, 40.0, 17.5), (None, 150.0, 40.0, 17.5),
                                 (None, 150.0, 40.0, 17.6)], "candid long, ra double, dec double, mag double")
    for c, idx in ((cat, 1), (cat.drop("galaxy_idx"), None)):
        first = KN.host_first(KN.host_match(cut, c)).collect()
        assert len(first) == 4 and {r.g_idx for r in first} == {idx} and {r.g_hyperleda for r in first} == {"N1"}
