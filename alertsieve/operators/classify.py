"""Classification of alerts (K1-K5) as one column expression.

The reference overwrites a label per flag in a fixed order (the last flag
wins), then marks alerts with more than one of {microlensing, SN, roid 2,
roid 3} as ambiguous, and finally lets a catalogue match override everything.
Here that is one ``CASE WHEN`` evaluated in reverse priority order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.columns import flag, resolve
from . import filters as FL

# flag name -> filter builder (K1)
FLAG_BUILDERS = {
    "tracklet": FL.tracklet_candidates,
    "simbad": FL.simbad_candidates,
    "early_sn": FL.early_sn_candidates,
    "sn": FL.sn_candidates,
    "microlensing": FL.microlensing_candidates,
    "kn": FL.kn_candidates,
    "roid3": FL.sso_ztf_candidates,
    "roid2": FL.sso_candidates,
}

FLAG_FILTERS = {
    "tracklet": "tracklet_candidates", "simbad": "simbad_candidates", "early_sn": "early_sn_candidates",
    "sn": "sn_candidates", "microlensing": "microlensing_candidates", "kn": "kn_candidates",
    "roid3": "sso_ztf_candidates", "roid2": "sso_candidates",
}

# Overwrite order of the reference (later entries win).
PRIORITY = [
    ("microlensing", S.CLASS_MICROLENSING),
    ("sn", S.CLASS_SN),
    ("early_sn", S.CLASS_EARLY_SN),
    ("kn", S.CLASS_KN),
    ("roid2", S.CLASS_SSO_CANDIDATE),
    ("tracklet", S.CLASS_TRACKLET),
    ("roid3", S.CLASS_SSO_MPC),
]
AMBIGUITY_FLAGS = ["microlensing", "sn", "roid2", "roid3"]


def alert_flags(df: DataFrame) -> dict[str, Column]:
    """K1: the eight non-null flags."""
    out = {}
    for k, builder in FLAG_BUILDERS.items():
        sql = FL.filter_sql(FLAG_FILTERS[k], df)
        out[k] = F.expr(f"coalesce({sql}, false)") if sql is not None else flag(builder(df))
    return out


def priority_class(flags: dict[str, Column]) -> Column:
    """K2: last-wins overwrite, written as CASE WHEN in reverse order."""
    expr = None
    for name, label in reversed(PRIORITY):
        expr = F.when(flags[name], F.lit(label)) if expr is None else expr.when(flags[name], F.lit(label))
    return expr.otherwise(F.lit(S.CLASS_UNKNOWN))


def ambiguity_count(flags: dict[str, Column]) -> Column:
    """K3: number of conflicting flags."""
    total = None
    for n in AMBIGUITY_FLAGS:
        t = flags[n].cast("long")
        total = t if total is None else total + t
    return total


def classify_from_flags(df: DataFrame, flags: dict[str, Column]) -> Column:
    """K2-K4: priority, then ambiguity, then the catalogue label override."""
    cds = resolve(df, "cdsxmatch")
    return (F.when(flags["simbad"], cds)
            .when(ambiguity_count(flags) > 1, F.lit(S.CLASS_AMBIGUOUS))
            .otherwise(priority_class(flags)))


def classify_parts_sql(df: DataFrame) -> dict[str, str]:
    """SQL text of K2 (``priority``), K3 (``n_conflicts``) and K2-K4 (``class``)."""
    fl = {k: f"coalesce({FL.filter_sql(n, df)}, false)" for k, n in FLAG_FILTERS.items()}
    prio = "CASE " + " ".join(f"WHEN {fl[n]} THEN '{lab}'" for n, lab in reversed(PRIORITY)) \
        + f" ELSE '{S.CLASS_UNKNOWN}' END"
    namb = "(" + " + ".join(f"CAST({fl[n]} AS BIGINT)" for n in AMBIGUITY_FLAGS) + ")"
    cds = FL.name_sql(df, "cdsxmatch")
    cls = (f"CASE WHEN {fl['simbad']} THEN {cds} WHEN {namb} > 1 THEN '{S.CLASS_AMBIGUOUS}' "
           f"ELSE {prio} END")
    return {"priority": prio, "n_conflicts": namb, "class": cls, **{"f_" + k: v for k, v in fl.items()}}


def classify_sql(df: DataFrame) -> str:
    """K2-K5 as one SQL ``CASE`` (one JVM call)."""
    return classify_parts_sql(df)["class"]


def classify(df: DataFrame) -> Column:
    """K5: class label of every alert."""
    if all(FL.filter_sql(n, df) is not None for n in FLAG_FILTERS.values()):
        return F.expr(classify_sql(df))
    return classify_from_flags(df, alert_flags(df))


def with_class(df: DataFrame, name: str = "class") -> DataFrame:
    return df.withColumn(name, classify(df))
