"""Hand-made alert rows for unit tests."""

from __future__ import annotations

from alertsieve.schema import ALERT, CANDIDATE, HISTORY_POINT

CAND_DEFAULT = dict(jd=2460000.5, jdstarthist=2459999.5, ndethist=5, drb=0.9, classtar=0.9, fid=1,
                    magpsf=18.0, sigmapsf=0.05, magnr=20.0, sigmagnr=0.02, magzpsci=26.0, isdiffpos="t",
                    ra=150.0, dec=40.0, ssdistnr=-999.0, ssnamenr="null", field=600, neargaia=10.0,
                    distpsnr1=10.0)
ALERT_DEFAULT = dict(candid=1, objectId="OBJ1", cdsxmatch="Unknown", roid=0, mulens=0.0,
                     snn_snia_vs_nonia=0.1, snn_sn_vs_all=0.1, rf_snia_vs_nonia=0.1, rf_kn_vs_nonkn=0.1,
                     rfscore=0.1, tracklet="")


def point(jd, fid=1, magpsf=18.0, sigmapsf=0.05, magnr=20.0, sigmagnr=0.02, magzpsci=26.0,
          isdiffpos="t", ssnamenr="null"):
    return dict(jd=jd, fid=fid, magpsf=magpsf, sigmapsf=sigmapsf, magnr=magnr, sigmagnr=sigmagnr,
                magzpsci=magzpsci, isdiffpos=isdiffpos, ssnamenr=ssnamenr)


def alert(candid=1, history=None, **kw):
    a = dict(ALERT_DEFAULT)
    c = dict(CAND_DEFAULT)
    for k, v in kw.items():
        if k in c:
            c[k] = v
        else:
            a[k] = v
    a["candid"] = candid
    row = [a[f] for f in ALERT.fieldNames()[:11]]
    cand = tuple(c[f] for f in CANDIDATE.fieldNames())
    hist = [tuple(p[f] for f in HISTORY_POINT.fieldNames()) for p in (history or [])]
    return tuple(row) + (cand, hist)


def alerts_df(spark, rows):
    return spark.createDataFrame(rows, ALERT)
