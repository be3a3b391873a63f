"""On a stored alert table, filters reach the parquet scan and only the named
(nested) fields are read."""

import contextlib
import io
import uuid

from alertsieve.operators import filters as FL
from alertsieve.operators.classify import classify
from alertsieve.plans.tables import alerts
from alertsieve.schema import ALERT
from alertsieve.session import ensure_checkpoint_dir
from conftest import SF001


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_pushdown_and_pruning(spark):
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/alerts-{uuid.uuid4().hex}"
    alerts(spark, SF001).write.parquet(path)
    a = spark.read.schema(ALERT).parquet(path)

    p = plan(FL.apply_filter(a, "rrlyr").select("candid"))
    assert "EqualTo(cdsxmatch,RRLyr)" in p
    assert "ReadSchema: struct<candid:bigint,cdsxmatch:string>" in p

    p = plan(FL.apply_filter(a, "sn_candidates").select("candid"))
    assert "GreaterThan(candidate.drb,0.5)" in p and "GreaterThan(candidate.classtar,0.4)" in p
    assert "prv_candidates" not in p.split("ReadSchema:")[1].splitlines()[0]

    # the classifier is one projection: no exchange, no Python
    p = plan(a.select("candid", classify(a).alias("class")))
    assert "Exchange" not in p and "Python" not in p and "ArrowEval" not in p


def test_public_catalogue_filters_push_their_cuts(spark):
    """The cuts reach the scan and each catalogue is joined once, broadcast or not."""
    import contextlib
    import io
    from alertsieve.operators import filters as FL
    from alertsieve.plans.tables import alerts, galaxies, sky_objects
    a, g, s = alerts(spark, SF001), galaxies(spark, SF001), sky_objects(spark, SF001)
    for limit in ("134217728", "-1"):
        spark.conf.set("alertsieve.broadcast.maxBytes", limit)
        try:
            for name, joins in (("early_kn_candidates", 2), ("rate_based_kn_candidates", 1)):
                df = FL.apply_filter(a, name, galaxies=g, sky_objects=s)
                buf = io.StringIO()
                with contextlib.redirect_stdout(buf):
                    df.explain("formatted")
                plan = buf.getvalue().split("== Initial Plan ==")[-1]
                assert "PushedFilters: []" not in plan.split("alert-table")[1].split("ReadSchema")[0]
                assert plan.count("Join type: Left") == joins or plan.count("LeftSemi") + plan.count("LeftAnti") >= joins
        finally:
            spark.conf.unset("alertsieve.broadcast.maxBytes")
