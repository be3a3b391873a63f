"""Sky joins of tables stored by cell equal the other joins, without an exchange."""

import math

import pytest
from pyspark.sql import functions as F

from alertsieve.operators import bucketed as B
from alertsieve.operators.skyjoin import explode_catalogue
from test_skyjoin import make, sep


@pytest.mark.parametrize("hot_rows", [1_000_000, 5])
def test_equal_to_brute_force(spark, hot_rows):
    left, cat, L, C = make(spark, seed=7)
    L = L.unionByName(spark.createDataFrame([(9000, None, 1.0), (9001, 3.0, None)], L.schema))
    truth = {(i, j) for i, ra, de in left for j, cra, cde, r in cat if sep(ra, de, cra, cde) <= r}
    cells = explode_catalogue(C, "c_ra", "c_dec", F.col("c_r"), 0.5, radius_name="c_rad")
    points, sources = B.store_points(L, "ra", "dec", buckets=4, hot_rows=hot_rows), B.store_catalogue(cells, buckets=4)
    assert (points.hot.count() > 0) == (hot_rows == 5)

    def run(how):
        return B.bucket_join(points, sources, "ra", "dec", "c_ra", "c_dec", how, radius_name="c_rad")
    pairs = [(r.id, r.cid) for r in run("inner").select("id", "cid").collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == truth
    assert {r.id for r in run("left_semi").collect()} == {i for i, _ in truth}
    assert sorted(r.id for r in run("left_anti").collect()) == sorted(
        {i for i, _, _ in left} - {i for i, _ in truth} | {9000, 9001})


def test_no_exchange_and_no_broadcast(spark):
    _, _, L, C = make(spark, seed=9)
    cells = explode_catalogue(C, "c_ra", "c_dec", F.col("c_r"), 0.5, radius_name="c_rad")
    points, sources = B.store_points(L, "ra", "dec", buckets=4), B.store_catalogue(cells, buckets=4)
    spark.conf.set("alertsieve.broadcast.maxBytes", "0")
    try:
        for how in ("inner", "left_anti", "left_semi"):
            df = B.bucket_join(points, sources, "ra", "dec", "c_ra", "c_dec", how, radius_name="c_rad")
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
    finally:
        spark.conf.unset("alertsieve.broadcast.maxBytes")
    assert math.isfinite(points.stored.count())
