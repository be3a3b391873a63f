"""Counts by night: equal to the full queries, and only changed nights are worked out."""

from pyspark.sql import functions as F

from alertsieve.operators import nightly as N
from alertsieve.plans import queries as Q
from alertsieve.plans.tables import alerts, galaxies, sky_objects
from alertsieve.session import delete_folder, run_folder
from alertsieve.sources.alerts import read_alerts, write_alerts
from conftest import SF01


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_one_new_night_and_a_removed_one(spark):
    a, g, s = alerts(spark, SF01), galaxies(spark, SF01), sky_objects(spark, SF01)
    night = F.floor("candidate.jd")
    nights = sorted(r[0] for r in a.select(night).distinct().collect())
    table, path = run_folder(spark, "alerts"), run_folder(spark, "nightly")
    write_alerts(a.filter(night < nights[-1]), table)
    assert N.refresh(spark, table, path, g, s) == nights[:-1]
    assert N.refresh(spark, table, path, g, s) == []
    write_alerts(a.filter(night == nights[-1]), table)
    seen = []
    read = N.read_alerts
    N.read_alerts = lambda *args: seen.append(read(*args)) or seen[-1]
    try:
        assert N.refresh(spark, table, path, g, s) == [nights[-1]]
    finally:
        N.read_alerts = read
    files = seen[0].filter(F.col("night").isin([nights[-1]])).select(F.input_file_name().alias("f")).distinct().collect()
    assert files and all(f"night={nights[-1]}" in r.f for r in files)
    for name, full in (("class_counts", Q.class_counts), ("label_counts", Q.simbad_type_counts),
                       ("filter_counts", Q.filter_counts), ("object_classes", Q.object_classes)):
        assert _rows(getattr(N, name)(spark, path)) == _rows(full(spark, SF01)), name
    delete_folder(spark, f"{table}/night={nights[0]}")
    write_alerts(a.filter(night == nights[1]).limit(3), table)  # more rows in a known night
    assert N.refresh(spark, table, path, g, s) == [nights[1]]
    left = read_alerts(spark, table)
    assert sum(r.n_alerts for r in N.object_classes(spark, path).collect()) == left.count()


def test_scan_names_only_the_changed_night(spark):
    a = alerts(spark, SF01)
    table = run_folder(spark, "alerts")
    write_alerts(a, table)
    some = read_alerts(spark, table).filter(F.col("night").isin([2460000]))
    plan = N.partial_rows(some, galaxies(spark, SF01), sky_objects(spark, SF01))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(night" in plan


def test_alerts_are_counted_before_labels_and_filters_are_taken_apart(spark):
    a = alerts(spark, SF01).withColumn("night", F.floor("candidate.jd"))
    rows = N.partial_rows(a, galaxies(spark, SF01), sky_objects(spark, SF01))
    lines = rows._jdf.queryExecution().executedPlan().toString().splitlines()
    generate, aggregates = (next(i for i, x in enumerate(lines) if "Generate explode" in x),
                            [i for i, x in enumerate(lines) if "Aggregate" in x])
    # the tree is printed from the top: below the explosion lies an aggregation of the alerts
    assert aggregates[-1] > generate
    got = rows.collect()
    assert len(got) == len({(r.night, r.kind, r.key, r.part) for r in got})
    assert sum(r.n for r in got if r.kind == "object") == a.count()


def test_missing_keys_of_counts_by_night(spark):
    a, g, s = alerts(spark, SF01), galaxies(spark, SF01), sky_objects(spark, SF01)
    odd = a.withColumn("night", F.lit(1).cast("long")).withColumn("objectId", F.when(F.col("candid") % 2 == 0, F.col("objectId")))
    odd = odd.withColumn("cdsxmatch", F.when(F.col("candid") % 3 == 0, F.col("cdsxmatch")))
    got = N.partial_rows(odd, g, s).collect()
    some = odd.agg(F.sum(F.col("objectId").isNull().cast("int")), F.sum(F.expr("cdsxmatch = 'RRLyr'").cast("int"))).first()
    assert sum(r.n for r in got if r.kind == "object" and r.key is None) == some[0] > 0
    assert [r.n for r in got if r.kind == "filter" and r.key == "rrlyr"] == [some[1]]
    assert [r.n for r in got if r.kind == "label" and r.key == "RRLyr"] == [some[1]]
    assert all(r.key is not None for r in got if r.kind != "object")
