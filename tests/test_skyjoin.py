"""Sky-cell cone join equals brute force, including RA wrap and the poles."""

import math

import numpy as np
from pyspark.sql import functions as F

from alertsieve.operators.skyjoin import cone_join, explode_catalogue


def sep(ra1, d1, ra2, d2):
    r1, e1, r2, e2 = map(math.radians, (ra1, d1, ra2, d2))
    h = math.sin((e2 - e1) / 2) ** 2 + math.cos(e1) * math.cos(e2) * math.sin((r2 - r1) / 2) ** 2
    return 2 * math.asin(min(1.0, math.sqrt(h)))


def make(spark, seed=3, n_left=400, n_cat=300):
    rng = np.random.default_rng(seed)
    # clusters at the RA seam, near both poles and at random places
    centres = [(0.0, 10.0), (359.99, -5.0), (45.0, 89.9), (200.0, -89.95), (120.0, 0.0), (300.0, 60.0)]
    left, cat = [], []
    for i in range(n_left):
        ra0, de0 = centres[i % len(centres)]
        left.append((i, float((ra0 + rng.normal(0, 0.3)) % 360), float(np.clip(de0 + rng.normal(0, 0.3), -90, 90))))
    for j in range(n_cat):
        ra0, de0 = centres[j % len(centres)]
        r = float(rng.choice([1e-4, 5e-3, 0.02]))       # radii in radians, some wider than a cell
        cat.append((j, float((ra0 + rng.normal(0, 0.3)) % 360), float(np.clip(de0 + rng.normal(0, 0.3), -90, 90)), r))
    L = spark.createDataFrame(left, "id long, ra double, dec double")
    C = spark.createDataFrame(cat, "cid long, c_ra double, c_dec double, c_r double")
    return left, cat, L, C


def test_inner_semi_anti_equal_brute_force(spark):
    left, cat, L, C = make(spark)
    truth = {(i, j) for i, ra, de in left for j, cra, cde, r in cat if sep(ra, de, cra, cde) <= r}
    assert truth, "fixture should produce matches"
    for cell in (0.25, 0.5, 2.0):
        cells = explode_catalogue(C, "c_ra", "c_dec", F.col("c_r"), cell, radius_name="c_rad")
        pairs = cone_join(L, cells, "ra", "dec", "c_ra", "c_dec", how="inner", radius_name="c_rad", cell_deg=cell)
        got = {(r.id, r.cid) for r in pairs.select("id", "cid").collect()}
        assert got == truth, f"cell {cell}"
        semi = {r.id for r in cone_join(L, cells, "ra", "dec", "c_ra", "c_dec", how="left_semi",
                                        radius_name="c_rad", cell_deg=cell).collect()}
        anti = {r.id for r in cone_join(L, cells, "ra", "dec", "c_ra", "c_dec", how="left_anti",
                                        radius_name="c_rad", cell_deg=cell).collect()}
        assert semi == {i for i, _ in truth}
        assert anti == {i for i, _, _ in left} - semi


def test_shuffle_path_equals_broadcast_path(spark):
    left, cat, L, C = make(spark, seed=5)
    cells = explode_catalogue(C, "c_ra", "c_dec", F.col("c_r"), 0.5, radius_name="c_rad")
    a = cone_join(L, cells, "ra", "dec", "c_ra", "c_dec", radius_name="c_rad", broadcast_max_bytes=0)
    b = cone_join(L, cells, "ra", "dec", "c_ra", "c_dec", radius_name="c_rad")
    assert sorted(map(tuple, a.select("id", "cid").collect())) == sorted(map(tuple, b.select("id", "cid").collect()))


def test_salted_shuffle_path_equals_brute_force(spark):
    left, cat, L, C = make(spark, seed=11)
    truth = {(i, j) for i, ra, de in left for j, cra, cde, r in cat if sep(ra, de, cra, cde) <= r}
    cells = explode_catalogue(C, "c_ra", "c_dec", F.col("c_r"), 0.5, radius_name="c_rad")
    pairs = cone_join(L, cells, "ra", "dec", "c_ra", "c_dec", radius_name="c_rad", broadcast_max_bytes=0,
                      salt_buckets=4)
    assert {(r.id, r.cid) for r in pairs.select("id", "cid").collect()} == truth
    anti = cone_join(L, cells, "ra", "dec", "c_ra", "c_dec", how="left_anti", radius_name="c_rad",
                     broadcast_max_bytes=0, salt_buckets=4)
    assert {r.id for r in anti.collect()} == {i for i, _, _ in left} - {i for i, _ in truth}
    assert "_salt_l" not in anti.columns and "_salt" not in pairs.columns
