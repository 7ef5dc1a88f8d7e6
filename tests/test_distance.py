import math
import random

import pytest
from pyspark.sql import functions as F

from tracklore.operators import dedup
from tracklore.operators.dualtree import distance_join
from tracklore.operators.proximity import matches_within, nearest_place

PT = "id long, lat double, lon double, extra string"


def hav(a, b):
    p, q = math.radians(a[1]), math.radians(b[1])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
    return 2 * 6_371_000 * math.asin(math.sqrt(min(1.0, h)))


def cloud(n, seed, lat, lon, spread):
    rnd = random.Random(seed)
    return [(i, lat + rnd.uniform(-spread, spread), lon + rnd.uniform(-spread, spread), "x") for i in range(n)]


@pytest.mark.parametrize("lat,lon,spread,radius", [(40.0, -90.0, 0.02, 150.0), (89.99, 0.0, 0.009, 400.0), (0.0, 179.999, 0.0009, 60.0), (52.0, 5.0, 0.5, 5000.0)])
def test_same_pairs_as_brute_force(spark, lat, lon, spread, radius):
    wrap = lambda p: (p[0], p[1], p[2] if p[2] <= 180 else p[2] - 360, p[3])
    a, b = [wrap(p) for p in cloud(150, 1, lat, lon, spread)], [wrap(p) for p in cloud(170, 2, lat, lon, spread)]
    b += [(1000 + i, a[0][1], a[0][2], "at the same place") for i in range(5)]
    want = {(x[0], y[0]) for x in a for y in b if hav(x, y) <= radius}
    left, right = spark.createDataFrame(a + a[:10], PT), spark.createDataFrame(b, PT)
    got = [tuple(r) for r in distance_join(left, right, radius, left_id="id", right_id="id").collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


def test_unusable_positions_and_empty(spark):
    nan = float("nan")
    bad = [(1, None, 1.0, None), (2, nan, 1.0, None), (3, 0.0, 0.0, None), (4, 91.0, 1.0, None), (5, 1.0, -181.0, None), (None, 1.0, 1.0, None)]
    good = spark.createDataFrame([(7, 1.0, 1.0, None), (8, 1.0, 1.0, "")], PT)
    assert distance_join(spark.createDataFrame(bad, PT), good, 1e5, left_id="id", right_id="id").count() == 0
    assert distance_join(spark.createDataFrame([], PT), good, 1e5, left_id="id", right_id="id").count() == 0
    assert distance_join(good, good, 10.0, left_id="id", right_id="id").count() == 4


def test_crowded_cell_is_cut_into_slots(spark, monkeypatch):
    from tracklore.operators import dualtree

    monkeypatch.setattr(dualtree, "SLOT", 16)
    many = spark.createDataFrame([(i, 40.0, -90.0, None) for i in range(100)], PT)
    few = spark.createDataFrame([(i, 40.0005, -90.0, None) for i in range(40)], PT)
    assert distance_join(many, few, 150.0, left_id="id", right_id="id").count() == 4000


def test_nearest(spark):
    ends = spark.createDataFrame([(1, 40.0, -89.0, None)], "e long, lat double, lon double, extra string")
    places = spark.createDataFrame([(5, 40.001, -89.0, None), (4, 40.001, -89.0, None), (6, 40.002, -89.0, None)], "p long, lat double, lon double, extra string")
    (r,) = nearest_place(matches_within(ends, places, 500.0, end_id="e", place_id="p"), "e", "p").collect()
    assert r.p == 4 and 111 < r.metres < 112


def greedy(points, radius):
    kept = []
    for p in sorted(points, key=lambda p: (-p[3], p[0])):
        if all(hav((0, p[1], p[2]), (0, k[1], k[2])) >= radius for k in kept):
            kept.append(p)
    return {p[0] for p in kept}


def test_leader_dedup_is_the_sequential_one(spark):
    rnd = random.Random(5)
    pts = [(i, 40 + rnd.uniform(0, 0.004), -89 + rnd.uniform(0, 0.004), float(rnd.randrange(5))) for i in range(120)]
    pts += [(200 + i, pts[i][1], pts[i][2], 9.0) for i in range(5)]
    df = spark.createDataFrame(pts, "id long, lat double, lon double, len double")
    got = {r.id for r in dedup.leader_dedup(df, "id", [-F.col("len")], 50.0).collect()}
    assert got == greedy(pts, 50.0)


def test_leader_dedup_fixture(spark):
    df = spark.createDataFrame([(1, 40.0, -89.0, 500.0), (2, 40.0001, -89.0001, 300.0), (3, 41.0, -88.0, 200.0), (4, None, None, 1.0)], "id long, lat double, lon double, len double")
    assert {r.id for r in dedup.leader_dedup(df, "id", [-F.col("len")], 50.0).collect()} == {1, 3, 4}
    assert dedup.leader_dedup(df.limit(0), "id", [-F.col("len")], 50.0).count() == 0
