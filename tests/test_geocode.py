import pytest
from pyspark.sql import functions as F

from tracklore.operators import geocode
from tracklore.operators.network import ELEMENTS
from tracklore.sources import io
from tracklore.streaming import arrivals

ADDRESS = "struct<road:string,city:string,town:string,village:string,state:string,postcode:string>"


def test_region():
    assert geocode.region_box({"x": (1.0, 2.0, 3.0, 4.0)}, "x") == (1.0, 2.0, 3.0, 4.0)
    with pytest.raises(KeyError):
        geocode.region_box({}, "narnia")


def test_features(spark):
    raw = spark.createDataFrame([([
        {"type": "way", "id": 1, "lat": 1.0, "lon": 1.0, "center": {"lat": 2.0, "lon": 3.0}, "tags": {"building": "warehouse", "name": "A"}},
        {"type": "node", "id": 2, "lat": 5.0, "lon": 6.0, "tags": {"man_made": "silo", "name": "B"}},
        {"type": "node", "id": 3, "lat": 5.0, "lon": 6.0, "tags": {"shop": "bakery", "name": "C"}},
        {"type": "node", "id": 4, "lat": 0.0, "lon": 6.0, "tags": {"craft": "x", "name": "D"}},
    ],)], ELEMENTS)
    assert sorted((r.id, r.lat, r.lon) for r in geocode.feature_points(raw).collect()) == [(1, 2.0, 3.0), (2, 5.0, 6.0)]


def test_ranked(spark):
    df = spark.createDataFrame([(1, "LOW", 1), (1, "MEDIUM", 2), (1, "HIGH", 3), (2, "LOW", 1)], "k int, confidence string, pos int")
    assert sorted((r.k, r.pos, r["rank"]) for r in geocode.ranked_places(df, "k", "pos").collect()) == [(1, 2, 2), (1, 3, 1), (2, 1, 1)]


def test_geocoded(spark):
    ends = spark.createDataFrame([(1, 40.00001, -89.0), (2, 41.0, -89.0), (3, 42.0, -89.0)], "osm_way_id long, lat double, lon double")
    answers = spark.createDataFrame(
        [(40.0, -89.0, "Mill", "man_made", "works", ("R", None, "T", None, "IL", "1")), (41.0, -89.0, "Main St", "highway", "road", ("Main St", None, None, None, None, None))],
        f"lat4 double, lon4 double, name string, category string, type string, address {ADDRESS}",
    )
    (r,) = geocode.geocoded(ends, answers).collect()
    assert (r.osm_way_id, r.company_name, r.city, r.facility_type, r.confidence) == (1, "Mill", "T", "man_made/works", "MEDIUM")
    assert {r.company_name for r in geocode.geocoded(ends, answers, True).collect()} == {"Mill", "Unknown facility near Main St"}


def test_states(spark):
    df = spark.createDataFrame([("new york", None), ("x", "Ny "), (None, None), ("x", "Texas")], "k string, s string")
    assert df.where(geocode.is_us_state(F.col("k"), F.col("s"), ["New York"], ["NY"])).count() == 2


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("A, \"x\"", "", None), ("B\nC", "y", "z")], "Company string, b string, c string")
    io.write_csv(df, str(tmp_path / "t"))
    assert sorted(r.Company for r in io.read_text_csv(spark, str(tmp_path / "t"), blank=True).collect()) == ['A, "x"', "B\nC"]
    io.write_csv(df, str(tmp_path / "dry"), dry_run=True)
    assert not (tmp_path / "dry").exists()
    assert io.known_accounts(spark, str(tmp_path / "none")).count() == 0
    assert sorted(r.company for r in io.known_accounts(spark, str(tmp_path / "t")).collect()) == ['a, "x"', "b\nc"]


def test_wkb(spark):
    import struct

    pts = [(-88.5, 40.25), (0.0, -0.5), (179.999999, -89.123456789)]
    rows = [(struct.pack("<BIdd", 1, 1, *p),) for p in pts] + [(struct.pack(">BIdd", 0, 1, *p),) for p in pts] + [(b"bad",), (None,)]
    got = [r.p for r in spark.createDataFrame(rows, "g binary").select(io.point_of_wkb(F.col("g")).alias("p")).collect()]
    assert [(p.lon, p.lat) for p in got[:6]] == pts * 2 and got[6:] == [None, None]


def test_stream(spark, tmp_path):
    rows = [(1, "a", "2024-01-01 00:00:00"), (1, "a", "2024-01-01 00:05:00"), (2, "b", "2024-01-01 01:00:00")]
    df = spark.createDataFrame(rows, "id int, k string, at string").withColumn("at", F.to_timestamp("at"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = arrivals.first_deliveries(stream, "id", "at").writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("once").count() == 2
    assert {r.id: r.at.minute for r in arrivals.latest(df, "id", "at").collect()} == {1: 5, 2: 0}
