"""Per-row filters on hand-made edge rows: NULL, NaN and exact boundaries."""


import pytest

from alertsieve.functions.columns import flag
from alertsieve.operators import filters as FL
from helpers import alert, alerts_df

NAN = float("nan")


def run(spark, name, rows):
    df = alerts_df(spark, rows)
    flags = {r.candid: r.f for r in df.select("candid", flag(FL.get_filter(name).builder(df)).alias("f")).collect()}
    kept = {r.candid for r in FL.apply_filter(df, name).select("candid").collect()}
    assert kept == {k for k, v in flags.items() if v}, "filter() and flag column disagree"
    assert all(v is not None for v in flags.values()), "flags must never be NULL"
    return flags


def test_label_filters(spark):
    rows = [alert(1, cdsxmatch="RRLyr"), alert(2, cdsxmatch=None), alert(3, cdsxmatch="Candidate_YSO"),
            alert(4, cdsxmatch="Candidate_TTau*"), alert(5, cdsxmatch="Unknown"), alert(6, cdsxmatch="Fail")]
    assert run(spark, "rrlyr", rows) == {1: True, 2: False, 3: False, 4: False, 5: False, 6: False}
    assert run(spark, "yso_candidates", rows) == {1: False, 2: False, 3: True, 4: True, 5: False, 6: False}
    # a missing label passes the catalogue filter (pandas ~isin semantics)
    assert run(spark, "simbad_candidates", rows) == {1: True, 2: True, 3: True, 4: True, 5: False, 6: False}


def test_sso_tracklet_microlensing(spark):
    rows = [alert(1, roid=3, tracklet="TRCK_1", mulens=0.2), alert(2, roid=2, tracklet=None, mulens=NAN),
            alert(3, roid=0, tracklet="", mulens=0.0), alert(4, roid=None, tracklet="XTRCK_", mulens=None)]
    assert run(spark, "sso_ztf_candidates", rows) == {1: True, 2: False, 3: False, 4: False}
    assert run(spark, "sso_candidates", rows) == {1: False, 2: True, 3: False, 4: False}
    assert run(spark, "tracklet_candidates", rows) == {1: True, 2: False, 3: False, 4: False}
    assert run(spark, "microlensing_candidates", rows) == {1: True, 2: False, 3: False, 4: False}


def test_sn_boundaries(spark):
    base = dict(snn_snia_vs_nonia=0.9, cdsxmatch="SN", drb=0.9, classtar=0.9, ndethist=5, roid=0,
                jd=2460090.5, jdstarthist=2460000.5)  # age exactly 90 passes (<=)
    rows = [alert(1, **base),
            alert(2, **{**base, "snn_snia_vs_nonia": 0.5}),            # 0.5 is not > 0.5
            alert(3, **{**base, "snn_snia_vs_nonia": NAN, "snn_sn_vs_all": 0.6}),
            alert(4, **{**base, "drb": 0.5}),
            alert(5, **{**base, "classtar": 0.4}),
            alert(6, **{**base, "ndethist": 1}),
            alert(7, **{**base, "roid": 3}),
            alert(8, **{**base, "jd": 2460090.6}),
            alert(9, **{**base, "drb": NAN}),
            alert(10, **{**base, "cdsxmatch": "Galaxy"}),
            alert(11, **{**base, "cdsxmatch": None})]
    assert run(spark, "sn_candidates", rows) == {1: True, 2: False, 3: True, 4: False, 5: False, 6: False,
                                                 7: False, 8: False, 9: False, 10: True, 11: False}


def test_early_sn_and_kn(spark):
    base = dict(snn_sn_vs_all=0.9, rf_snia_vs_nonia=0.9, rf_kn_vs_nonkn=0.9, cdsxmatch="Unknown",
                drb=0.9, classtar=0.9, ndethist=20, jd=2460019.5, jdstarthist=2460000.0)
    rows = [alert(1, **base), alert(2, **{**base, "ndethist": 21}), alert(3, **{**base, "rf_snia_vs_nonia": 0.5}),
            alert(4, **{**base, "cdsxmatch": "SN"}), alert(5, **{**base, "jd": 2460020.0})]
    assert run(spark, "early_sn_candidates", rows) == {1: True, 2: False, 3: False, 4: True, 5: True}
    # kn: ndethist < 20 and age < 20 are strict; SN label is not in the kilonova list
    assert run(spark, "kn_candidates", rows) == {1: False, 2: False, 3: False, 4: False, 5: False}
    rows2 = [alert(6, **{**base, "ndethist": 19}), alert(7, **{**base, "ndethist": 19, "jd": 2460020.0})]
    assert run(spark, "kn_candidates", rows2) == {6: True, 7: False}


def test_snialike(spark):
    rows = [alert(1, rfscore=0.1, cdsxmatch="Unknown", neargaia=5.1, distpsnr1=5.1),
            alert(2, rfscore=0.1, cdsxmatch="Unknown", neargaia=5.0, distpsnr1=6.0),
            alert(3, rfscore=0.0, cdsxmatch="Unknown", neargaia=6.0, distpsnr1=6.0)]
    assert run(spark, "snialike", rows) == {1: True, 2: False, 3: False}


def test_registry_paths_and_unknown(spark):
    assert FL.get_filter("alertsieve.operators.filters.rrlyr").name == "rrlyr"
    for unknown in ("nope", "some.module.path.rrlyr", "alertsieve.operators.filters.nope"):
        with pytest.raises(KeyError):
            FL.get_filter(unknown)


def test_apply_filter_catalogue_filters(spark):
    from alertsieve.plans.tables import alerts, galaxies, sky_objects
    from conftest import SF001
    a, g, s = alerts(spark, SF001), galaxies(spark, SF001), sky_objects(spark, SF001)
    assert FL.apply_filter(a, "early_kn_candidates", galaxies=g, sky_objects=s).count() == 3
    got = FL.apply_filter(a, "alertsieve.operators.kilonova.rate_based_kn_candidates", sky_objects=s)
    assert got.count() == 2 and got.columns == a.columns
    with pytest.raises(ValueError):
        FL.apply_filter(a, "early_kn_candidates")
