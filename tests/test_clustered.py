"""The clustered alert table: reads equal a full scan and list few files; tables that change are read anew."""

import glob
import json
import math
import os
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from alertsieve.plans.tables import alerts, clustered_table_path
from alertsieve.sources import clustered as CL
from conftest import SF001, SF01
from test_skyjoin import sep

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _ids(df):
    return sorted(r[0] for r in df.select("candid").collect())


@pytest.mark.parametrize("ra, dec, radius", [(150.0, 20.0, 12.0), (0.0, -10.0, 6.0), (359.9, 30.0, 3.0),
                                             (10.0, 89.0, 30.0), (77.0, -95.0, 5.0), (200.0, 40.0, 0.0)])
def test_cone_equals_full_scan(spark, ra, dec, radius):
    path = clustered_table_path(spark, SF01)
    all_ = alerts(spark, SF01).select("candid", "candidate.ra", "candidate.dec").collect()
    assert len(spark.read.parquet(f"{path}/files").collect()) > 100
    want = sorted(r.candid for r in all_ if sep(r.ra, r.dec, ra, dec) <= math.radians(radius))
    assert _ids(CL.read_clustered(spark, path, ra, dec, radius)) == want


def test_whole_table_times_and_objects(spark):
    path, a = clustered_table_path(spark, SF01), alerts(spark, SF01)
    assert _ids(CL.read_clustered(spark, path)) == _ids(a)
    first, last = a.agg(F.min("candidate.jd"), F.max("candidate.jd")).first()
    at = first + (last - first) / 3
    got = CL.read_clustered(spark, path, first_jd=at, last_jd=at + 0.5)
    assert _ids(got) == _ids(a.filter(F.col("candidate.jd").between(at, at + 0.5))) != []
    one = a.select("objectId", "candidate.ra", "candidate.dec").first()
    assert _ids(CL.read_object(spark, path, one.objectId, one.ra, one.dec, 0.1)) == _ids(a.filter(F.col("objectId") == one.objectId))


def test_missing_positions_and_empty_tables(spark):
    from helpers import alert, alerts_df
    from alertsieve.session import run_folder
    rows = [alert(1, ra=None), alert(2, dec=None), alert(3, jd=None), alert(4, ra=10.0, dec=10.0), alert(5, ra=370.0, dec=10.0)]
    path = run_folder(spark, "clustered")
    CL.write_clustered(alerts_df(spark, rows), path, 2)
    assert _ids(CL.read_clustered(spark, path)) == [1, 2, 3, 4, 5]
    assert _ids(CL.read_clustered(spark, path, 10.0, 10.0, 1.0)) == [4, 5]
    with pytest.raises(ValueError):
        CL.write_clustered(alerts_df(spark, rows), path, 2)
    empty = run_folder(spark, "clustered")
    CL.write_clustered(alerts_df(spark, []), empty)
    assert _ids(CL.read_clustered(spark, empty, 1.0, 1.0, 1.0)) == []


def test_a_crowded_place_is_cut_into_files(spark):
    from helpers import alert, alerts_df
    from alertsieve.session import run_folder
    path = run_folder(spark, "clustered")
    CL.write_clustered(alerts_df(spark, [alert(i, ra=5.0, dec=5.0, jd=2460000.25) for i in range(4000)]), path, 8)
    sizes = [r.n for r in spark.read.parquet(f"{path}/files").collect()]
    assert len(sizes) >= 7 and max(sizes) < 1500


SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", "file://" + {log!r}).config("spark.eventLog.compress", "false")
         .config("spark.eventLog.rolling.enabled", "false").config("spark.sql.shuffle.partitions", "8").getOrCreate())
from alertsieve.plans.queries import cone_alerts
n = cone_alerts(spark, {sf!r}).count()
spark.sparkContext.setJobDescription("measured")
assert cone_alerts(spark, {sf!r}).count() == n
print("ROWS", n)
spark.stop()
"""


def test_cone_query_reads_few_files():
    """The scan metrics of the event log: under a tenth of the 128 files are read."""
    log = tempfile.mkdtemp(prefix="alertsieve-log-")
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT, log=log, sf=SF001)], capture_output=True,
                         text=True, timeout=600, cwd=tempfile.mkdtemp(prefix="alertsieve-cwd-"))
    assert "ROWS" in out.stdout, out.stderr[-3000:]
    ids, files = {}, []

    def scans(plan):
        if plan["nodeName"].startswith("Scan parquet"):
            for m in plan["metrics"]:
                if m["name"] == "number of files read":
                    ids[m["accumulatorId"]] = "/data/" in json.dumps(plan["metadata"]) or "candidate" in plan["simpleString"]
        for child in plan["children"]:
            scans(child)
    seen = False
    for line in open(glob.glob(os.path.join(log, "*"))[0]):
        event = json.loads(line)
        if "sparkPlanInfo" in event:
            seen = seen or event.get("description") == "measured"
            scans(event["sparkPlanInfo"])
        if event["Event"].endswith("DriverAccumUpdates") and seen:
            files += [v for k, v in event["accumUpdates"] if ids.get(k)]
    assert files and 0 < max(files) < 12.8


def test_tables_written_again_in_place_are_read_anew(spark, tmp_path):
    """Same names, other rows: no query may answer from the old table."""
    from alertsieve.plans import queries as Q
    for t in ("events", "customer", "part"):
        spark.read.parquet(f"{SF001}/{t}.parquet").coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
    files = [f for f in glob.glob(f"{tmp_path}/events.parquet/*.parquet")]
    assert len(files) == 1 and Q.classify(spark, str(tmp_path)).count() == 1000
    few = spark.read.parquet(f"{SF001}/events.parquet").orderBy("event_id").limit(100).toArrow()
    import pyarrow.parquet as pq
    pq.write_table(few, files[0])
    for crc in glob.glob(f"{tmp_path}/events.parquet/.*.crc"):
        os.replace(crc, crc + ".old")
    assert Q.classify(spark, str(tmp_path)).count() == 100
    assert Q.cone_alerts(spark, str(tmp_path)).count() <= 100
