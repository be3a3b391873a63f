"""Alert table round trip with night partitions; topic folders."""

import contextlib
import io
import uuid

from pyspark.sql import functions as F

from alertsieve.operators.routing import route_topics
from alertsieve.plans.tables import alerts
from alertsieve.session import ensure_checkpoint_dir
from alertsieve.sources.alerts import read_alerts, write_alerts, write_topics
from conftest import SF001


def test_alert_table_roundtrip_and_pruning(spark):
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tbl-{uuid.uuid4().hex}"
    a = alerts(spark, SF001)
    write_alerts(a, f"{base}/alerts", mode="overwrite")
    back = read_alerts(spark, f"{base}/alerts")
    assert back.count() == a.count()
    nights = sorted(r.night for r in back.select("night").distinct().collect())
    one = back.filter(F.col("night") == nights[0])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        one.select("candid").explain("formatted")
    assert "PartitionFilters: [isnotnull(night" in buf.getvalue()
    assert one.count() == a.filter(F.floor("candidate.jd") == nights[0]).count()

    write_topics(route_topics(back), f"{base}/topics", mode="overwrite")
    t = spark.read.parquet(f"{base}/topics")
    assert t.count() == route_topics(a).count()
    assert t.filter("topic = 'rrlyr'").count() == 45
