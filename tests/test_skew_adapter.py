"""The range-partitioned prefix scan gives the same alerts as a window per object."""


from alertsieve.operators.classify import classify
from alertsieve.sources import fixtures as FX
from conftest import SF01


def _by_window(ev):
    """The per-object window that the prefix scan must equal."""
    slim = FX._slim_events(ev)
    by = "PARTITION BY obj ORDER BY ts, event_id"
    return FX._project_alert(slim.selectExpr(
        "event_id", "obj", "jd", f"min(jd) OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS jdstarthist",
        f"CAST(row_number() OVER ({by}) AS BIGINT) AS ndethist",
        f"collect_list({FX._history_point_sql()}) OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        " AS prv_candidates"))


def test_prefix_scan_equals_window(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    plain = _by_window(ev)
    # 64 range partitions of ~160 events: most objects straddle partition borders
    safe = FX.events_to_alerts(ev, n_parts=64)
    cols = ["candid", "candidate.jdstarthist", "candidate.ndethist", "CAST(prv_candidates AS STRING)"]
    assert sorted(map(tuple, plain.selectExpr(*cols).collect())) == sorted(map(tuple, safe.selectExpr(*cols).collect()))
    got = sorted(map(tuple, safe.select("candid", classify(safe).alias("c")).collect()), key=str)
    want = sorted(map(tuple, plain.select("candid", classify(plain).alias("c")).collect()), key=str)
    assert got == want


def test_hot_object_is_never_gathered(spark):
    """One object holds a third of the events over 64 partitions: the history is that of the window per object, and no
    window or exchange by object alone carries points."""
    from pyspark.sql import functions as F
    ev = spark.read.parquet(f"{SF01}/events.parquet").filter("event_id % 8 = 0")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 24 == 0, F.lit(7)).otherwise(F.col("user_id")))
    hot = hot.withColumn("props", F.when(F.col("user_id") == 7, F.lit('{"k": 1}')).otherwise(F.col("props")))
    got = FX.object_history(FX._slim_events(hot), 64)
    by = "PARTITION BY obj ORDER BY ts, event_id"
    want = FX._slim_events(hot).selectExpr(
        "event_id", "obj", "jd", f"min(jd) OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS jdstarthist",
        f"CAST(row_number() OVER ({by}) AS BIGINT) AS ndethist",
        f"collect_list({FX._history_point_sql()}) OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        " AS prv_candidates")
    rows = lambda df: sorted((r.event_id, r.jdstarthist, r.ndethist, str(r.prv_candidates)) for r in df.collect())
    assert rows(got) == rows(want)
    assert got.groupBy("obj").count().agg(F.max("count")).first()[0] > hot.count() / 3.5
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and "collect_list" in line:
            assert "_pid" in line.rsplit("], [", 2)[1], line  # points: by object and partition


def test_one_pass_flags_salted_path_equals_broadcast(spark):
    """With broadcasting disabled by the size bound, the existence probes use
    the salted shuffle path and give the same flags."""
    from alertsieve.operators import kilonova as KN
    from alertsieve.plans.tables import alerts, galaxies, sky_objects
    a, g, s = alerts(spark, SF01), galaxies(spark, SF01), sky_objects(spark, SF01)
    want = sorted(map(tuple, KN.catalogue_flags(a, g, s).collect()))
    spark.conf.set("alertsieve.broadcast.maxBytes", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = KN.catalogue_flags(a, g, s)
        got = sorted(map(tuple, df.collect()))
    finally:
        spark.conf.unset("alertsieve.broadcast.maxBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert got == want
    assert sum(r[2] for r in got) == 46 and sum(r[3] for r in got) == 8
