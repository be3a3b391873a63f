"""A stream of alerts classified with availableNow equals the batch result."""


from alertsieve.operators.classify import classify
from alertsieve.plans.tables import alerts
from alertsieve.streaming.stream import run_classification_stream, run_topic_stream
from alertsieve.operators.routing import route_topics
from conftest import SF001


def test_stream_equals_batch(spark):
    a = alerts(spark, SF001)
    streamed = run_classification_stream(spark, a)
    batch = a.select("candid", "objectId", classify(a).alias("class"))
    key = lambda r: (r.candid, r.objectId, r["class"])
    assert sorted(map(key, streamed.collect())) == sorted(map(key, batch.collect()))


def test_topic_stream_partitioned(spark):
    a = alerts(spark, SF001)
    out = run_topic_stream(spark, a)
    got = sorted((r.topic, r.candid) for r in out.select("topic", "candid").collect())
    want = sorted((r.topic, r.candid) for r in route_topics(a).collect())
    assert got == want


def test_kilonova_stream_equals_batch(spark):
    from alertsieve.operators import kilonova as KN
    from alertsieve.plans.tables import galaxies, sky_objects
    from alertsieve.streaming.stream import run_kilonova_stream
    sf = "/root/testdata/sf0.01"
    a, g, s = alerts(spark, sf), galaxies(spark, sf), sky_objects(spark, sf)
    got = sorted((r.topic, r.candid) for r in run_kilonova_stream(spark, a, g, s).collect())
    want = sorted([("early_kn_candidates", r.candid) for r in KN.early_kn_candidates(a, g, s).collect()]
                  + [("rate_based_kn_candidates", r.candid) for r in KN.rate_based_kn_candidates(a, s).collect()])
    assert got == want and len(got) == 46 + 8


def test_notification_stream_idempotent(spark):
    from alertsieve.plans.tables import galaxies, sky_objects
    from alertsieve.plans.queries import notify_channels
    from alertsieve.streaming.stream import run_notification_stream
    sf = "/root/testdata/sf0.01"
    a, g, s = alerts(spark, sf), galaxies(spark, sf), sky_objects(spark, sf)
    table, sink = run_notification_stream(spark, a, g, s)
    got = sorted(map(tuple, spark.read.parquet(table).select("topic", "candid", "channel").collect()))
    want = sorted(map(tuple, notify_channels(spark, sf).select("topic", "candid", "channel").collect()))
    assert got == want and len(got) == 1116
    sink(a, 999)                       # a replayed batch adds nothing
    assert spark.read.parquet(table).count() == len(got)


def test_all_topics_stream_one_pass(spark):
    from alertsieve.plans.queries import route_topics as route_all
    from alertsieve.plans.tables import galaxies, sky_objects
    sf = "/root/testdata/sf0.01"
    a = alerts(spark, sf)
    out = run_topic_stream(spark, a, galaxies=galaxies(spark, sf), sky_objects=sky_objects(spark, sf))
    got = sorted((r.topic, r.candid) for r in out.select("topic", "candid").collect())
    want = sorted((r.topic, r.candid) for r in route_all(spark, sf).collect())
    assert got == want and len(got) == 10474


def _notes(spark, rows):
    return spark.createDataFrame(rows, "topic string, candid long, channel string, obs_date string")


def test_sink_writes_repeats_once_and_reads_only_its_dates(spark):
    from alertsieve.session import run_folder
    from alertsieve.streaming.stream import notification_sink
    table = run_folder(spark, "sink")
    sink = notification_sink(table)
    sink(_notes(spark, [("kn", 1, "main", "2024-01-01")] * 3 + [("kn", 2, "main", None)]), 0)
    assert spark.read.parquet(table).count() == 2
    sink(_notes(spark, [("kn", 1, "main", "2024-01-01"), ("kn", 1, "broker", "2024-01-01"), ("kn", 2, "main", None)]), 1)
    assert spark.read.parquet(table).count() == 3


def test_sink_reports_an_unreadable_table(spark):
    import pytest
    from alertsieve.session import run_folder
    from alertsieve.streaming.stream import notification_sink
    table = run_folder(spark, "sink")
    spark.createDataFrame([("not a table",)], "x string").write.text(f"{table}/obs_date=2024-01-01")
    with pytest.raises(Exception):
        notification_sink(table)(_notes(spark, [("kn", 1, "main", "2024-01-01")]), 0)


def test_catalogue_csv_by_header_without_index(spark):
    from alertsieve.operators.catalogue import read_catalogue
    from alertsieve.session import run_folder
    path = run_folder(spark, "csv")
    (spark.createDataFrame([("PGC1", "J1", 10.0, -30.0, 50.0, 2.0, 9.5, 48.0)],
                           "HyperLEDA_name string, `2MASS_name` string, ra double, dec double, lum_dist double, "
                           "dist_err double, stellarmass double, ang_dist double")
     .write.option("header", True).csv(path))
    row = read_catalogue(spark, path, "csv").first()
    assert (row.ra, row.dec, row.lum_dist, row.dist_err, row.ang_dist) == (10.0, -30.0, 50.0, 2.0, 48.0)
    assert "galaxy_idx" not in row.asDict()


def test_batch_that_breaks_off_stays_unseen_and_is_replayed(spark, monkeypatch):
    import pytest
    from alertsieve.session import run_folder
    from alertsieve.streaming import stream as ST
    table = run_folder(spark, "sink")
    sink = ST.notification_sink(table)
    rows = [("kn", i, c, f"2024-01-0{1 + i % 3}") for i in range(9) for c in ("main", "broker")]
    sink(_notes(spark, rows[:4]), 0)

    def killed(*_):
        raise RuntimeError("killed between two files")
    with monkeypatch.context() as m:
        m.setattr(ST, "_commit", killed)  # all data files are there, the record isn't
        with pytest.raises(RuntimeError):
            sink(_notes(spark, rows), 1)
    key = lambda: sorted((r.topic, r.candid, r.channel) for r in ST.read_notifications(spark, table).collect())
    assert key() == sorted(r[:3] for r in rows[:4])
    assert spark.read.parquet(table).count() > 4  # files of the broken attempt
    sink(_notes(spark, rows), 1)
    assert key() == sorted(r[:3] for r in rows)
    sink(_notes(spark, rows), 1)
    sink(_notes(spark, []), 2)
    assert key() == sorted(r[:3] for r in rows)


def test_sink_works_its_batch_out_once(spark):
    from pyspark.sql import functions as F
    from alertsieve.session import run_folder
    from alertsieve.streaming import stream as ST
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b
    table = run_folder(spark, "sink")
    sink = ST.notification_sink(table)
    for epoch in (0, 1):  # the second meets a table that holds rows
        start = runs.value
        notes = _notes(spark, [("kn", 10 * epoch + i, "main", "2024-01-01") for i in range(5)])
        sink(notes.mapInArrow(count, notes.schema), epoch)
        assert runs.value - start == 5
    assert ST.read_notifications(spark, table).filter(F.col("epoch_id") == 1).count() == 5


def test_catalogue_replaced_between_two_batches_changes_the_second_only(spark, monkeypatch):
    from pyspark.sql import functions as F
    from alertsieve.operators.catalogue import current_version, publish_catalogue, read_version
    from alertsieve.plans.tables import galaxies, sky_objects
    from alertsieve.session import run_folder
    from alertsieve.streaming import stream as ST
    sf = "/root/testdata/sf0.01"
    a, g, s = alerts(spark, sf), galaxies(spark, sf), sky_objects(spark, sf)
    base = run_folder(spark, "versions")
    halves = [a.filter("candid % 2 = 0"), a.filter("candid % 2 = 1")]
    for half in halves:
        half.coalesce(1).write.mode("append").parquet(f"{base}/in")
    assert publish_catalogue(g, f"{base}/galaxies") == "v00000001"
    publish_catalogue(s, f"{base}/sky")
    none = s.withColumn("type", F.lit(1).cast("long"))  # every object vetoes
    rows, commits = ST.channel_rows, []

    def between(batch, galaxies_, sky):
        commits.append(sorted(r[0] % 2 for r in batch.select("candid").distinct().limit(1).collect()))
        out = rows(batch, galaxies_, sky)
        if len(commits) == 1:
            publish_catalogue(none, f"{base}/sky")  # while the first batch runs
        return out
    monkeypatch.setattr(ST, "channel_rows", between)
    table = ST.run_versioned_stream(spark, f"{base}/in", a.schema, f"{base}/galaxies", f"{base}/sky", f"{base}/run", 1)
    assert len(commits) == 2 and current_version(spark, f"{base}/sky") == "v00000002"
    order = [halves[c[0]] for c in commits]
    want = rows(order[0], g, s).unionByName(rows(order[1], g, read_version(spark, f"{base}/sky")))
    key = lambda df: sorted(map(tuple, df.select("topic", "candid", "channel").collect()))
    got = key(ST.read_notifications(spark, table))
    assert got == key(want) and got != key(rows(a, g, s))
    # a replay of the first batch takes the version that it took first
    assert ST.batch_versions(spark, f"{base}/run", 0, [f"{base}/galaxies", f"{base}/sky"]) == ["v00000001", "v00000001"]
    assert ST.batch_versions(spark, f"{base}/run", 7, [f"{base}/galaxies", f"{base}/sky"]) == ["v00000001", "v00000002"]
