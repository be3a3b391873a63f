"""The index of several cell sizes: equal to brute force, a bounded number of cells, the same hosts as from pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from alertsieve.operators import kilonova as KN
from alertsieve.operators import levelcells as LC
from alertsieve.plans.tables import alerts, galaxies
from conftest import SF001
from test_skyjoin import sep

SF01 = "/root/testdata/sf0.01"
CENTRES = [(0.0, 10.0), (359.9999, -5.0), (45.0, 89.9), (200.0, -89.99), (120.0, 0.0), (300.0, 60.0), (10.0, 90.0)]
RADII = [2e-5, 1e-4, 5e-3, 0.02, math.radians(2.0), 0.2]


def make(spark, seed, n_left=350, n_cat=240):
    rng = np.random.default_rng(seed)

    def at(i, spread):
        ra, dec = CENTRES[i % len(CENTRES)]
        return float((ra + rng.normal(0, spread)) % 360), float(np.clip(dec + rng.normal(0, spread), -90, 90))
    left = [(i, *at(i, [1e-3, 0.05, 0.8][i % 3])) for i in range(n_left)]
    cat = [(j, *at(j, [1e-3, 0.05, 0.8][j % 3]), float(rng.choice(RADII))) for j in range(n_cat)]
    return (left, cat, spark.createDataFrame(left, "id long, ra double, dec double"),
            spark.createDataFrame(cat, "cid long, c_ra double, c_dec double, c_r double"))


@pytest.mark.parametrize("seed, max_bytes", [(1, None), (2, "0")])
def test_pairs_and_nearest_equal_brute_force(spark, seed, max_bytes):
    left, cat, points, sources = make(spark, seed)
    near = {(i, j): sep(ra, de, cra, cde) for i, ra, de in left for j, cra, cde, r in cat}
    truth = {(i, j) for (i, j), s in near.items() if s <= cat[j][3]}
    if max_bytes:
        spark.conf.set("alertsieve.broadcast.maxBytes", max_bytes)
    try:
        indexed = LC.index_catalogue(sources, "c_ra", "c_dec", "c_r")
        got = [(r.id, r.cid) for r in LC.level_join(points, indexed, "ra", "dec", "c_ra", "c_dec").collect()]
        assert len(got) == len(set(got)) and set(got) == truth  # every pair meets once
        from alertsieve.functions.sky import ang_sep_sql
        first = LC.nearest(points, indexed, ["c_r", "cid", "c_ra", "c_dec"], "ra", "dec",
                           f"{ang_sep_sql('ra', 'dec', 's.c_ra', 's.c_dec')} <= s.c_r")
        chosen = {r.id: r.cid for r in first.selectExpr("id", "_source.cid AS cid").collect()}
    finally:
        spark.conf.unset("alertsieve.broadcast.maxBytes")
    want = {}
    for i, j in sorted(truth, key=lambda p: (cat[p[1]][3], p[1])):
        want.setdefault(i, j)
    assert chosen == want


def test_cells_of_a_source_are_bounded(spark):
    rows = [(float(ra), float(dec), float(r)) for ra in (0.0, 0.01, 123.4, 359.99) for dec in range(-85, 86, 5)
            for r in [math.radians(2.0) / 1.7 ** k for k in range(20)]]
    sources = spark.createDataFrame(rows, "c_ra double, c_dec double, c_r double").withColumn("cid", F.monotonically_increasing_id())
    counts = LC.index_catalogue(sources, "c_ra", "c_dec", "c_r").groupBy("cid").count()
    assert counts.agg(F.max("count")).first()[0] <= LC.MOST_CELLS
    assert counts.count() == len(rows)


def test_missing_values_match_nothing(spark):
    nan = float("nan")
    points = spark.createDataFrame([(1, None, 1.0), (2, nan, 1.0), (3, 5.0, None), (4, 5.0, 5.0), (5, 365.0, 5.0)],
                                   "id long, ra double, dec double")
    sources = spark.createDataFrame([(1, None, 1.0, 0.1), (2, 5.0, 5.0, None), (3, 5.0, nan, 0.1), (4, 5.0, 5.0, nan), (5, 5.0, 5.0, 1e-9)],
                                    "cid long, c_ra double, c_dec double, c_r double")
    indexed = LC.index_catalogue(sources, "c_ra", "c_dec", "c_r")
    pairs = LC.level_join(points, indexed, "ra", "dec", "c_ra", "c_dec").collect()
    assert {(r.id, r.cid) for r in pairs} == {(4, 5), (5, 5)}
    none = LC.index_catalogue(sources.limit(0), "c_ra", "c_dec", "c_r")
    assert LC.level_join(points, none, "ra", "dec", "c_ra", "c_dec").count() == 0
    assert LC.nearest(points, none, ["cid"], "ra", "dec", "true").count() == 0


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_nearest_host_equals_host_of_pairs(spark, sf):
    cut, gal = KN.early_kn_cut_alerts(alerts(spark, sf)), galaxies(spark, sf)
    # repeated galaxies and repeated alerts
    gal, cut = gal.unionByName(gal.limit(40)), cut.unionByName(cut.limit(30))
    columns = [*cut.columns, *KN.HOST_ORDER, "abs_mag"]
    a = sorted(map(str, KN.nearest_host(cut, gal).select(*columns).collect()))
    b = sorted(map(str, KN.host_first(KN.host_match(cut, gal)).select(*columns).collect()))
    assert a == b and (sf == SF001 or len(a) > 40)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exchange_behind_the_join(spark):
    gal = galaxies(spark, SF001)
    plan = _plan(KN.nearest_host(KN.early_kn_cut_alerts(alerts(spark, SF001)), gal))
    stem = plan.split("Initial Plan")[-1] if "Initial Plan" in plan else plan
    above = stem[:stem.index("BroadcastExchange")]  # nodes above and on the alerts' side of the first join
    assert "Exchange" not in above.replace("BroadcastExchange", "") and "Aggregate" not in above


def test_stream_with_hosts_equals_batch(spark):
    from alertsieve.plans.queries import stream_early_kn
    from alertsieve.plans.tables import sky_objects
    batch = KN.early_kn_candidates(alerts(spark, SF01), galaxies(spark, SF01), sky_objects(spark, SF01))
    got = sorted((r.candid, r.galaxy_idx) for r in stream_early_kn(spark, SF01).collect())
    assert got == sorted((r.candid, r.g_idx) for r in batch.collect()) and len(got) == 46
