"""Filter and class counts on the derived alerts equal the expected counts."""


import __spark_entry__ as E
from alertsieve.plans.oracle import oracle_sql
from alertsieve.plans.queries import Q
from conftest import SF001

EXPECTED_SF001 = {"rrlyr": 45, "yso_candidates": 103, "simbad_candidates": 450, "sso_ztf_candidates": 40,
                  "sso_candidates": 40, "tracklet_candidates": 25, "microlensing_candidates": 33,
                  "snialike": 145, "sn_candidates": 150, "early_sn_candidates": 92, "kn_candidates": 78,
                  "orphan_grb": 5, "early_kn_candidates": 3, "rate_based_kn_candidates": 2}


def test_filter_counts_sf001(spark):
    got = {r["filter"]: r["n"] for r in E.queries()["filter_counts"](spark, SF001).collect()}
    assert got == EXPECTED_SF001


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["class", "n"]
    assert dict((r["class"], r["n"]) for r in rows)["Unknown"] == 364


def test_every_query_has_an_oracle():
    assert set(Q) == set(oracle_sql())
    assert set(Q) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
