"""Classification priority, ambiguity and the catalogue override."""

from alertsieve.operators.classify import classify
from helpers import alert, alerts_df

SN = dict(snn_snia_vs_nonia=0.9, drb=0.9, classtar=0.9, ndethist=5, jd=2460010.5, jdstarthist=2460000.5)


def classes(spark, rows):
    df = alerts_df(spark, rows)
    return {r.candid: r.c for r in df.select("candid", classify(df).alias("c")).collect()}


def test_priority_and_overrides(spark):
    rows = [
        alert(1),                                                     # nothing -> Unknown
        alert(2, **SN),                                               # SN candidate
        alert(3, **SN, mulens=0.5),                                   # SN + microlensing -> Ambiguous
        alert(4, **{**SN, "rf_snia_vs_nonia": 0.9}),                  # SN + early SN -> Early SN Ia
        alert(5, roid=2, tracklet="TRCK_9"),                          # tracklet wins over roid 2
        alert(6, **SN, cdsxmatch="Galaxy"),                           # galaxy label overrides
        alert(7, roid=3, tracklet="TRCK_1"),                          # MPC is applied last
        alert(8, cdsxmatch=None),                                     # missing label -> NULL class
        alert(9, mulens=0.3),                                         # microlensing only
        alert(10, **{**SN, "rf_kn_vs_nonkn": 0.9, "ndethist": 5}),    # KN overwrites SN
    ]
    assert classes(spark, rows) == {
        1: "Unknown", 2: "SN candidate", 3: "Ambiguous", 4: "Early SN Ia candidate", 5: "Tracklet",
        6: "Galaxy", 7: "Solar System MPC", 8: None, 9: "Microlensing candidate", 10: "Kilonova candidate"}
