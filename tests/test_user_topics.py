"""Filters outside the package: by module path, and as routed topics."""

from pyspark.sql import functions as F

from alertsieve.operators import filters as FL
from alertsieve.operators.routing import route_topics
from alertsieve.plans.queries import Q
from alertsieve.plans.tables import alerts, galaxies, sky_objects
from alertsieve.streaming.stream import run_topic_stream
from conftest import SF001


def test_filters_by_path(spark):
    a = alerts(spark, SF001)
    young = FL.apply_filter(a, "example_filters.young_supernova")
    assert young.count() == a.filter("cdsxmatch IN ('SN', 'Candidate_SN*') AND "
                                     "candidate.jd - candidate.jdstarthist <= 30").count() > 0
    bright = FL.apply_filter(a, "example_filters.bright_variable")  # columns by argument name, pandas
    assert bright.count() == a.filter("cdsxmatch = 'RRLyr' AND candidate.magpsf < 18").count() > 0


def test_registered_topic_is_routed_and_flagged(spark):
    a = alerts(spark, SF001)
    FL.register_filter("user_faint", lambda df: F.expr("candidate.magpsf > 20"), topic="faint")
    try:
        want = a.filter("candidate.magpsf > 20").count()
        assert route_topics(a).filter("topic = 'faint'").count() == want > 0
        assert FL.with_flags(a).filter("f_user_faint").count() == want
        out = run_topic_stream(spark, a, galaxies=galaxies(spark, SF001), sky_objects=sky_objects(spark, SF001))
        assert out.filter("topic = 'faint'").count() == want
    finally:
        FL.unregister_filter("user_faint")
    assert route_topics(a).filter("topic = 'faint'").count() == 0
    assert "user_bright" not in FL.REGISTRY
    assert Q["route_user_topic"](spark, SF001).filter("topic = 'user_bright'").count() > 0


def test_flat_alerts(spark):
    a, g, s = alerts(spark, SF001), galaxies(spark, SF001), sky_objects(spark, SF001)
    flat = a.select("*", "candidate.*").drop("candidate")
    for name, kw in (("early_kn_candidates", {"galaxies": g, "sky_objects": s}),
                     ("rate_based_kn_candidates", {"sky_objects": s}), ("orphan_grb", {}), ("sn_candidates", {})):
        got = FL.apply_filter(flat, name, **kw)
        want = FL.apply_filter(a, name, **kw)
        assert sorted(r.candid for r in got.collect()) == sorted(r.candid for r in want.collect())
        assert got.columns == flat.columns and want.columns == a.columns
