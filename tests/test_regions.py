import random

import pytest
from pyspark.sql import functions as F

from tracklore.operators import geocode, reports, rules
from tracklore.operators.regions import regions_of_points

BOX = "code string, min_lat double, min_lon double, max_lat double, max_lon double, lat string"


def run(points, boxes):
    return sorted(tuple(r) for r in regions_of_points(points, boxes, point_id="id", region_id="code").collect())


def test_regions_against_brute_force(spark):
    rnd = random.Random(2)
    pts = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(300)] + [(300 + i, rnd.gauss(40, 0.05), rnd.gauss(-90, 0.05)) for i in range(300)]
    pts += [(900, 10.0, 20.0), (900, 10.0, 20.0), (901, None, 1.0), (902, float("nan"), 1.0), (903, 0.0, 0.0), (904, 91.0, 0.0), (None, 10.0, 20.0), (905, 90.0, 180.0)]
    boxes = [("whole", -90.0, -180.0, 90.0, 180.0, "x"), ("beyond", -500.0, -500.0, 500.0, 500.0, "x"), ("edge", 10.0, 20.0, 10.0, 20.0, "x"), ("none", 5.0, 5.0, 4.0, 6.0, "x"), ("null", None, 0.0, 1.0, 1.0, "x"), (None, 0.0, 0.0, 1.0, 1.0, "x")]
    boxes += [(f"b{i}", a, b, a + rnd.uniform(0, 30), b + rnd.uniform(0, 60), "x") for i in range(12) for a, b in [(rnd.uniform(-60, 60), rnd.uniform(-150, 100))]] + [("small", 39.98, -90.03, 40.01, -89.99, "x")] * 2
    points, regions = spark.createDataFrame(pts, "id long, lat double, lon double"), spark.createDataFrame(boxes, BOX)
    fine = lambda p: p[0] is not None and p[1] is not None and abs(p[1]) <= 90 and (p[1], p[2]) != (0, 0)
    want = {(p[0], b[0]) for p in pts if fine(p) for b in boxes if b[0] and None not in b[:5] and b[1] <= p[1] <= b[3] and b[2] <= p[2] <= b[4]}
    assert run(points, regions) == sorted(want)
    assert run(points.limit(0), regions) == run(points, regions.limit(0)) == []


@pytest.mark.parametrize(
    ("kind", "tags", "hit"),
    [("way", {"building": "big_warehouse", "name": "A"}, True), ("node", {"building": "warehouse", "name": "A"}, False), ("way", {"landuse": "industrial_old", "name": "A"}, False), ("way", {"landuse": "industrial", "name": "A"}, True), ("node", {"amenity": "fuel", "name": "A"}, False), ("node", {"amenity": "fuel", "name": "A", "brand": "B"}, True), ("way", {"building": "yes", "operator": "B"}, True)],
)
def test_branches_ask_for_the_element(spark, kind, tags, hit):
    df = spark.createDataFrame([(kind, tags)], "e string, t map<string,string>")
    assert df.where(geocode.is_industrial_feature(F.col("t"), F.col("e"))).count() == hit


@pytest.mark.parametrize(("name", "reason"), [("US-60", "highway"), ("Highway 101", "highway"), ("Highway-101", ""), ("I 80", "highway"), ("US 82;AL 14", "highway"), ("CR 12;US 34", "highway"), ("Interstate 40", "highway"), ("Interstate40", "")])
def test_roads(spark, name, reason):
    assert spark.createDataFrame([(name,)], "n string").select(rules.junk_reason(F.col("n")).alias("r")).first().r == reason


def test_quality_needs_town_and_state(spark):
    df = spark.createDataFrame([("Acme", "Doon", "IL"), ("Acme", "Doon", " "), ("Acme", None, "IL"), ("Main Street", None, None), (None, "Doon", "IL")], "n string, c string, s string")
    assert [r[0] for r in df.select(rules.data_quality(F.col("n"), F.col("c"), F.col("s"))).collect()] == ["complete", "no_location", "no_location", "low_quality_name", "complete"]


def test_named_features_and_sectors(spark):
    df = spark.createDataFrame([({"name": "A"},), ({"name": "A", "highway": "x"},), ({"name": ""},), (None,)], "tags map<string,string>")
    assert geocode.named_features(df).count() == 1
    rows = spark.createDataFrame([("il", "Metals"), ("il", "Metals"), ("il", None), ("oh", " ")], "state_key string, sector_guess string")
    assert [tuple(r) for r in reports.sectors_by_region(rows, "state_key").collect()] == [("il", "Metals", 2)]
