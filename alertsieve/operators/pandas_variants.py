"""The same SN filter and classifier as vectorised pandas UDFs.

These exist to measure the native column expressions against the execution
model of scalar pandas UDFs (Arrow batches shipped to a Python worker).  They
follow the same semantics (NaN fails comparisons, a missing label is not in a
list, a NULL id or score makes the flag False).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.columns import resolve
from .classify import PRIORITY


def _make_udfs():
    """Build the UDF bodies as closures: cloudpickle ships them by value, with
    only plain lists and numpy/pandas inside, so Python workers do not need
    this package on their path."""
    sn_keep, kn_keep = list(S.SN_KEEP), list(S.KN_KEEP)
    not_match, prefix = list(S.SIMBAD_NOT_A_MATCH), S.TRACKLET_PREFIX
    order = list(PRIORITY)
    unknown, ambiguous = S.CLASS_UNKNOWN, S.CLASS_AMBIGUOUS

    def flags(cds, roid, mulens, snn1, snn2, rf_snia, ndet, drb, classtar, jd, jdstart, rf_kn, tracklet):
        def gt(s, v):
            x = pd.to_numeric(s, errors="coerce").astype(float).to_numpy()
            return np.nan_to_num(x, nan=-np.inf) > v

        def isin(s, labels):
            return s.isin(labels).to_numpy() & s.notna().to_numpy()

        snn = gt(snn1, 0.5) | gt(snn2, 0.5)
        age = pd.to_numeric(jd).to_numpy(dtype=float) - pd.to_numeric(jdstart).to_numpy(dtype=float)
        nd = pd.to_numeric(ndet).to_numpy(dtype=float)
        r = pd.to_numeric(roid).to_numpy(dtype=float)
        good = gt(drb, 0.5) & gt(classtar, 0.4)
        return {
            "tracklet": tracklet.fillna("").astype(str).str.startswith(prefix).to_numpy(),
            "simbad": ~isin(cds, not_match),
            "early_sn": snn & isin(cds, sn_keep) & good & (nd <= 20) & gt(rf_snia, 0.5),
            "sn": snn & isin(cds, sn_keep) & (age <= 90) & good & (nd > 1) & ~np.isnan(r) & (r != 3),
            "microlensing": gt(mulens, 0.0),
            "kn": gt(rf_kn, 0.5) & good & (age < 20) & (nd < 20) & isin(cds, kn_keep),
            "roid3": r == 3,
            "roid2": r == 2,
        }

    def sn_pdf(cds: pd.Series, roid: pd.Series, snn1: pd.Series, snn2: pd.Series, ndet: pd.Series,
               drb: pd.Series, classtar: pd.Series, jd: pd.Series, jdstart: pd.Series) -> pd.Series:
        nan = pd.Series(np.full(len(cds), np.nan))
        f = flags(cds, roid, nan, snn1, snn2, nan, ndet, drb, classtar, jd, jdstart, nan,
                  pd.Series([""] * len(cds)))
        return pd.Series(f["sn"])

    def classify_pdf(cds: pd.Series, roid: pd.Series, mulens: pd.Series, snn1: pd.Series, snn2: pd.Series,
                     rf_snia: pd.Series, ndet: pd.Series, drb: pd.Series, classtar: pd.Series, jd: pd.Series,
                     jdstart: pd.Series, rf_kn: pd.Series, tracklet: pd.Series) -> pd.Series:
        f = flags(cds, roid, mulens, snn1, snn2, rf_snia, ndet, drb, classtar, jd, jdstart, rf_kn, tracklet)
        out = np.full(len(cds), unknown, dtype=object)
        for name, label in order:
            out[f[name]] = label
        n = sum(f[k].astype(int) for k in ("microlensing", "sn", "roid2", "roid3"))
        out[n > 1] = ambiguous
        out = np.where(f["simbad"], cds.to_numpy(dtype=object), out)
        return pd.Series(out, dtype=object)

    return (F.pandas_udf(sn_pdf, returnType=T.BooleanType()),
            F.pandas_udf(classify_pdf, returnType=T.StringType()))


_SN_ARGS = ["cdsxmatch", "roid", "snn_snia_vs_nonia", "snn_sn_vs_all", "ndethist", "drb", "classtar", "jd",
            "jdstarthist"]
_CLASS_ARGS = ["cdsxmatch", "roid", "mulens", "snn_snia_vs_nonia", "snn_sn_vs_all", "rf_snia_vs_nonia",
               "ndethist", "drb", "classtar", "jd", "jdstarthist", "rf_kn_vs_nonkn", "tracklet"]

sn_udf, classify_udf = _make_udfs()


def sn_candidates_udf(df: DataFrame) -> Column:
    return sn_udf(*[resolve(df, c) for c in _SN_ARGS])


def classify_with_udf(df: DataFrame) -> Column:
    return classify_udf(*[resolve(df, c) for c in _CLASS_ARGS])
