"""Text columns: sexagesimal carry, signs, UTC rounding, bands, links, DC magnitude."""

import math

from pyspark.sql import functions as F

from alertsieve.functions import text as TX
from alertsieve.functions.photometry import dc_mag, dc_mag_sql


def test_sexagesimal_and_utc(spark):
    rows = [(1, 0.0, 0.0, 2451545.0), (2, 359.99999999, -0.5, 2460000.49999999999),
            (3, 15.0 * (1 + 59 / 60 + 59.995 / 3600), 89.9999999, 2440587.5),
            (4, 180.0, -89.5, 2460310.0 + 0.5 / 86400000)]
    df = spark.createDataFrame(rows, "id long, ra double, dec double, jd double")
    out = {r.id: r for r in df.select("id", TX.ra_hms(F.col("ra")).alias("h"), TX.dec_dms(F.col("dec")).alias("d"),
                                      TX.jd_to_utc(F.col("jd")).alias("t")).collect()}
    assert out[1].h == "0 00 00.00" and out[1].d == "+0 00 00.0" and out[1].t == "2000-01-01 12:00:00.000"
    assert out[2].h == "24 00 00.00" and out[2].d == "-0 30 00.0"
    assert out[3].h == "2 00 00.00" and out[3].d == "+90 00 00.0" and out[3].t == "1970-01-01 00:00:00.000"
    assert out[4].h == "12 00 00.00" and out[4].d == "-89 30 00.0"


def test_band_links_friday(spark):
    df = spark.createDataFrame([(1, "OBJ1", 1, 10.5, -20.25, "2024-01-05"), (3, "OBJ2", 3, 0.0, 0.0, "2024-01-06")],
                               "fid long, oid string, f long, ra double, dec double, day string")
    r = df.select(TX.band_name(F.col("fid")).alias("b"), TX.portal_link(F.col("oid"), "https://x/").alias("p"),
                  TX.tns_link(F.col("ra"), F.col("dec")).alias("t"),
                  TX.is_friday(F.to_date("day")).alias("fri")).collect()
    assert [x.b for x in r] == ["g", None]
    assert r[0].p == "https://x/OBJ1" and "ra=10.5000000&decl=-20.2500000" in r[0].t
    assert [x.fri for x in r] == [True, False]


def test_dc_mag_signs_and_invalid_flux(spark):
    rows = [(1, 18.0, 0.05, 20.0, 0.02, 26.0, "t"), (2, 18.0, 0.05, 20.0, 0.02, 26.0, "1"),
            (3, 21.0, 0.05, 20.0, 0.02, 26.0, "f"), (4, 20.0, 0.05, 20.0, 0.02, 26.0, "0"),
            (5, None, 0.05, 20.0, 0.02, 26.0, "t"), (6, 18.0, 0.05, 20.0, 0.02, 26.0, "f")]
    df = spark.createDataFrame(rows, "id long, magpsf double, sigmapsf double, magnr double, sigmagnr double, "
                                     "magzpsci double, isdiffpos string")
    c = [F.col(n) for n in ("magpsf", "sigmapsf", "magnr", "sigmagnr", "magzpsci", "isdiffpos")]
    out = {r.id: r for r in df.select("id", dc_mag(F.lit(1), *c).alias("a"),
                                      F.expr(dc_mag_sql("")).alias("b")).collect()}
    fr, fd = 10 ** (-0.4 * (20 - 26)), 10 ** (-0.4 * (18 - 26))
    assert abs(out[1].a.mag - (26 - 2.5 * math.log10(fr + fd))) < 1e-12
    assert out[1].a.mag == out[2].a.mag                      # 't' and '1' are both positive
    fd21 = 10 ** (-0.4 * (21 - 26))
    assert abs(out[3].a.mag - (26 - 2.5 * math.log10(fr - fd21))) < 1e-9   # negative subtraction
    assert out[6].a.mag is None                              # negative total flux -> NULL
    assert out[4].a.mag is None                              # zero total flux -> NULL, no error
    assert out[5].a.mag is None
    for r in out.values():                                   # SQL-text and Column forms agree
        assert (r.a.mag, r.a.err) == (r.b.mag, r.b.err)


def test_column_helpers(spark):
    from alertsieve.functions.columns import as_double, as_int, label_eq, label_in, prefix_match
    df = spark.createDataFrame([(1, "SN", "TRCK_1", 3.7, float("nan")), (2, None, None, -3.7, 1.0)],
                               "id long, lab string, trk string, x double, y double")
    r = {x.id: x for x in df.select(
        "id", label_in(F.col("lab"), ["SN", "Galaxy"]).alias("i"), label_eq(F.col("lab"), "SN").alias("e"),
        prefix_match(F.col("trk"), "TRCK_").alias("p"), as_int(F.col("x")).alias("n"),
        as_double(F.col("y")).alias("d")).collect()}
    assert (r[1].i, r[1].e, r[1].p, r[1].n, r[1].d) == (True, True, True, 3, None)   # NaN -> NULL
    assert (r[2].i, r[2].e, r[2].p, r[2].n, r[2].d) == (False, False, False, -3, 1.0)  # truncation toward 0
