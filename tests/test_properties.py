"""Property tests: random alerts (NULL / NaN / boundary values) against a plain
Python model of the per-row filter semantics (NaN fails every comparison, a
missing label is not in a list, NULL never yields a NULL flag)."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from alertsieve import schema as S
from alertsieve.functions.columns import flag
from alertsieve.operators import filters as FL
from alertsieve.operators.classify import classify
from helpers import alert, alerts_df

NAN = float("nan")
score = st.one_of(st.none(), st.just(NAN), st.sampled_from([0.0, 0.4, 0.5, 0.9]),
                  st.floats(0, 1, allow_nan=False))
labels = st.one_of(st.none(), st.sampled_from(["Unknown", "Galaxy", "SN", "RRLyr", "Candidate_YSO", "QSO",
                                               "Fail", "Transient", "Candidate_SN*", "Seyfert_1"]))
row = st.fixed_dictionaries({
    "cdsxmatch": labels, "roid": st.one_of(st.none(), st.integers(0, 4)),
    "mulens": score, "snn_snia_vs_nonia": score, "snn_sn_vs_all": score, "rf_snia_vs_nonia": score,
    "rf_kn_vs_nonkn": score, "drb": score, "classtar": score,
    "tracklet": st.one_of(st.none(), st.sampled_from(["", "TRCK_12", "xTRCK_"])),
    "ndethist": st.integers(0, 25), "age": st.sampled_from([0.1, 0.25, 14.0, 19.9, 20.0, 90.0, 91.0]),
})


def gt(x, v):
    return x is not None and not math.isnan(x) and x > v


def model(r):
    age = r["age"]
    cds, roid = r["cdsxmatch"], r["roid"]
    snn = gt(r["snn_snia_vs_nonia"], 0.5) or gt(r["snn_sn_vs_all"], 0.5)
    f = {
        "tracklet": r["tracklet"] is not None and r["tracklet"].startswith("TRCK_"),
        "simbad": cds not in S.SIMBAD_NOT_A_MATCH,
        "early_sn": snn and cds in S.SN_KEEP and gt(r["drb"], 0.5) and gt(r["classtar"], 0.4)
        and r["ndethist"] <= 20 and gt(r["rf_snia_vs_nonia"], 0.5),
        "sn": snn and cds in S.SN_KEEP and age <= 90 and gt(r["drb"], 0.5) and gt(r["classtar"], 0.4)
        and r["ndethist"] > 1 and roid is not None and roid != 3,
        "microlensing": gt(r["mulens"], 0.0),
        "kn": gt(r["rf_kn_vs_nonkn"], 0.5) and gt(r["drb"], 0.5) and gt(r["classtar"], 0.4) and age < 20
        and r["ndethist"] < 20 and cds in S.KN_KEEP,
        "roid3": roid == 3, "roid2": roid == 2,
    }
    cls = "Unknown"
    for name, label in [("microlensing", S.CLASS_MICROLENSING), ("sn", S.CLASS_SN),
                        ("early_sn", S.CLASS_EARLY_SN), ("kn", S.CLASS_KN), ("roid2", S.CLASS_SSO_CANDIDATE),
                        ("tracklet", S.CLASS_TRACKLET), ("roid3", S.CLASS_SSO_MPC)]:
        if f[name]:
            cls = label
    if sum(f[n] for n in ("microlensing", "sn", "roid2", "roid3")) > 1:
        cls = S.CLASS_AMBIGUOUS
    if f["simbad"]:
        cls = cds
    return f, cls


FLAG_NAMES = {"tracklet": "tracklet_candidates", "simbad": "simbad_candidates", "early_sn": "early_sn_candidates",
              "sn": "sn_candidates", "microlensing": "microlensing_candidates", "kn": "kn_candidates",
              "roid3": "sso_ztf_candidates", "roid2": "sso_candidates"}


@settings(max_examples=6, deadline=None)
@given(st.lists(row, min_size=30, max_size=120))
def test_flags_and_class_match_model(spark, rows):
    data = [alert(i, jd=2460000.0 + r["age"], jdstarthist=2460000.0,
                  **{k: v for k, v in r.items() if k != "age"}) for i, r in enumerate(rows)]
    df = alerts_df(spark, data)
    cols = [flag(FL.get_filter(n).builder(df)).alias(k) for k, n in FLAG_NAMES.items()]
    got = {x.candid: x for x in df.select("candid", classify(df).alias("cls"), *cols).collect()}
    for i, r in enumerate(rows):
        f, cls = model(r)
        g = got[i]
        for k in FLAG_NAMES:
            assert g[k] is not None, "flags are never NULL"
            assert g[k] == f[k], (k, r)
        assert g.cls == cls, r
